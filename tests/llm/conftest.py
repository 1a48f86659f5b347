import pytest
from pyspark.sql import SparkSession


@pytest.fixture
def frame(spark: SparkSession):
    """frame(rows, schema, parts): a small DataFrame dealt over several partitions."""
    def make(rows, schema, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)
    return make
