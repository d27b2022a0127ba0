"""The funnel counts of every batch as a table: ``(run, batch_id, stage, task, rows)``.

A batch's rows are written before its result and only once: the first try of a
batch knows which devices were new, a replay finds them stored already.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daystream.sinks.upsert import table_exists

SCHEMA = "stage string, task int, rows long, run string, batch_id long"


def append_counts(spark: SparkSession, counts: DataFrame, path: str, run_id: str, batch_id: int) -> None:
    """Record ``counts`` (stage, task, rows), one row per stage and task, unless the batch has its record."""
    folder = f"{path}/run={run_id}/batch_id={batch_id}"
    if not table_exists(spark, f"{folder}/_SUCCESS"):
        counts.select("stage", "task", "rows").coalesce(1).write.mode("overwrite").parquet(folder)


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def totals(log: DataFrame) -> DataFrame:
    """``(stage, rows)`` over all batches and tasks."""
    return log.groupBy("stage").agg(F.sum("rows").alias("rows"))
