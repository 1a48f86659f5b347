"""ledgerflow: a PySpark-native sales ETL, profiling and forecasting engine.

Every public function takes and returns Spark DataFrames (or dicts of
them); nothing is collected to the driver except small reports a caller
asks for explicitly.
"""

__version__ = "0.1.0"
