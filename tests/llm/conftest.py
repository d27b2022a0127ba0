import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """Rows (doc_id, text) with an id clash-prone extra column."""
    def make(rows, schema="doc_id long, text string"):
        from pyspark.sql import functions as F
        return spark.createDataFrame(rows, schema).withColumn("uid", F.lit("clash")).withColumn("rank", F.lit(1)).withColumn("n", F.lit(2.5))
    return make
