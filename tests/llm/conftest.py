import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()


EDGES = [(1, None, "a"), (2, "", "b"), (3, "  \n ", None), (None, "one two", "a"), (4, "x " * 3000, "a"), (4, "x " * 3000, "a"), (5, "ünï cødé " * 40, None)]


@pytest.fixture
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns with the operators' internal names."""
    rows = [(i, t, s, 7, 8, 9, "z") for i, t, s in EDGES]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, p int, size int, score int, key string")
