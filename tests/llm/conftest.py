import pytest
from pyspark.sql import SparkSession


@pytest.fixture
def docs(spark: SparkSession):
    """Makes a documents table from (doc_id, text) pairs, with columns whose names clash with results."""
    def make(rows, lang=None):
        return spark.createDataFrame(
            [(i, x, (lang or {}).get(i), "src0", None if x is None else len(x)) for i, x in rows],
            "doc_id long, text string, lang string, source string, n_chars long")
    return make


@pytest.fixture
def labels(spark: SparkSession):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    return make
