"""The table lists that a batch was routed with, kept so that a replay uses them again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daystream.sinks.upsert import table_exists


def recorded_routing(spark: SparkSession, path: str, run_id: str, batch_id: int, routing: DataFrame) -> DataFrame:
    """``(table, kind)`` of the batch's first try, else ``routing``, recorded now.

    The record is whole once its ``_SUCCESS`` marker is there; a first try that
    stopped before it wrote no output either, so it may choose again.
    """
    folder = f"{path}/run={run_id}/batch_id={batch_id}"
    if not table_exists(spark, f"{folder}/_SUCCESS"):
        routing.select("table", "kind").distinct().coalesce(1).write.mode("overwrite").parquet(folder)
    return spark.read.schema("table string, kind string").parquet(folder)
