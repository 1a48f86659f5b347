from ledgerflow.sources.csv_tables import (  # noqa: F401
    choose_tables, load_csv_tables, missing_tables, table_name_from_file,
)
from ledgerflow.sources.star import star_tables  # noqa: F401
