"""Append-only store of latest dimension rows.

Every batch adds a folder ``run=<id>/batch_id=<n>/table=<t>`` with the latest
row of each key it changed; nothing stored is rewritten, so a reader sees a
batch's folder or not, never a table with half its buckets replaced, and the
cost of a batch follows the batch. The row of a key is the one saved last
(then by message time, partition and offset). A replay overwrites its own
folder. Rows of fenced runs (:mod:`daystream.sinks.fence`) are ordered by run and
batch, whatever the clocks of their drivers say, and come after those without
a fence, which are ordered by time.

Compaction adds one more folder that holds the current rows with their own
order, which changes no answer whether it is complete or not; the folders it
has read are dropped by a separate call, once no reader uses them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daystream.sinks.upsert import drop_folder, list_folders, table_exists

DIM_COLS = ["table", "id", "data", "op", "src_partition", "src_offset", "src_ts", "deleted",
            "saved_at", "fence", "save"]
DIM_SCHEMA = ("id string, data string, op string, src_partition int, src_offset bigint, "
              "src_ts timestamp, deleted boolean, saved_at timestamp, fence bigint, save bigint, run string, "
              "batch_id bigint, table string")


def append_dims(latest: DataFrame, path: str, run_id: str, batch_id: int,
                on_delete: str = "keep", fence: int | None = None) -> None:
    """Add a batch's latest rows (:func:`daystream.operators.cdc.dim_latest`).

    ``on_delete="drop"`` stores a delete as a tombstone that readers skip.
    ``fence``: number of a fenced run, whose batches are numbered by ``batch_id``.
    """
    deleted = (F.col("op") == "D") if on_delete == "drop" else F.lit(False)
    save = F.lit(None if fence is None else batch_id).cast("bigint")
    rows = (latest.withColumn("deleted", deleted).withColumn("saved_at", F.current_timestamp())
            .withColumn("fence", F.lit(fence).cast("bigint")).withColumn("save", save))
    (rows.select(*DIM_COLS).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("table").parquet(f"{path}/run={run_id}/batch_id={batch_id}"))


def read_dims(spark: SparkSession, path: str,
              tables: tuple[str, ...] = ("user_info", "base_province")) -> DataFrame:
    """Current rows of ``tables`` (pruned by the table folder), tombstones left
    out; a store that does not exist yet reads as empty."""
    return current(_rows(spark, path, tables)).where(~F.col("deleted"))


def _rows(spark, path, tables=()):
    if not table_exists(spark, path):
        return spark.createDataFrame([], DIM_SCHEMA).select(*DIM_COLS)
    df = spark.read.schema(DIM_SCHEMA).parquet(path)
    return (df.where(F.col("table").isin(*tables)) if tables else df).select(*DIM_COLS)


def current(rows: DataFrame) -> DataFrame:
    """The row saved last of each key; partial aggregation before the shuffle."""
    rest = [c for c in DIM_COLS if c not in ("table", "id")]
    order = F.struct("fence", F.when(F.col("fence").isNull(), F.col("saved_at")), "save",
                     "src_ts", "src_partition", "src_offset")
    return (rows.groupBy("table", "id").agg(F.max_by(F.struct(*rest), order).alias("w"))
            .select("table", "id", "w.*"))


def compact_dims(spark: SparkSession, path: str) -> list[str]:
    """Add a snapshot folder; returns the folders it replaces, for
    :func:`drop_compacted` once readers that listed them are done."""
    old = list_folders(spark, path, 2)
    name = uuid.uuid4().hex[:12]
    (current(_rows(spark, path)).write.partitionBy("table")
     .parquet(f"{path}/run=compacted-{name}/batch_id=0"))
    return old


def drop_compacted(spark: SparkSession, folders: list[str]) -> None:
    for f in folders:
        drop_folder(spark, f)
