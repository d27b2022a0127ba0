"""Idempotent keyed upsert into a partitioned parquet table.

A document index replaces a document with the same id; plain files cannot
do that, so an upsert rewrites the partitions it touches:

1. read only the touched partitions of the stored table (see
   :func:`touched_partitions`),
2. keep stored rows whose key is not in the incoming batch, add the
   incoming rows,
3. write the result to a staging table under the shared checkpoint root
   (this cuts the lineage, so the final overwrite never reads the files it
   replaces, and a lost executor only recomputes from the staging copy),
4. overwrite just those partitions with ``partitionOverwriteMode=dynamic``.

Applying the same batch twice gives the same table. The overwrite replaces
one partition folder after another, so it is meant for one writer without
readers at that moment (back-fills, corrections); the jobs' own outputs are
append-only.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daystream.session import scratch_path

def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table folder exists. (A write with dynamic partition
    overwrite leaves no ``_SUCCESS`` marker at the root, so the folder
    itself is the test; an empty folder reads as an empty table.)"""
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read a partitioned table with a fixed schema (no partition-value type
    inference: ``dt=2024-01-01`` stays text)."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def touched_partitions(stored: DataFrame, incoming: DataFrame, partition_col: str) -> DataFrame:
    """Rows of ``stored`` in the partitions that ``incoming`` touches.

    One path for any number of partitions: the smallest and largest touched
    value prune the folders that are listed and read (a batch's days lie
    close together), and a semi join on the exact values drops the folders
    between them that are not touched.
    """
    lo, hi = incoming.agg(F.min(partition_col), F.max(partition_col)).first()
    if lo is None:
        return stored.limit(0)
    return (stored.where(F.col(partition_col).between(lo, hi))
            .join(incoming.select(partition_col).distinct(), partition_col, "left_semi"))


def stage(spark: SparkSession, df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to a fresh folder under the shared checkpoint root
    and read it back: later steps reuse the rows instead of recomputing
    them, and a lost executor recomputes from the copy, not the source.
    The copy stays; per-batch code uses :func:`staged`, which drops it."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged(spark: SparkSession, df: DataFrame, name: str = "stage"):
    """:func:`stage` for the length of a ``with`` block; the copy is deleted
    at its end (through the file system API, so also on shared storage)."""
    path = scratch_path(spark, name)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        drop_folder(spark, path)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def drop_folder(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def list_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Folders ``depth`` levels below ``path`` (none if it does not exist)."""
    p, fs = _fs(spark, path + "/*" * depth)
    found = fs.globStatus(p) or []
    return sorted(f.getPath().toString() for f in found if f.isDirectory())


def write_clustered(df: DataFrame, path: str, partition_col: str, keys: list[str],
                    mode: str = "overwrite") -> None:
    """Write ``df`` partitioned by ``partition_col`` with rows range-clustered
    on the keys, so each task writes one or two partition folders (few,
    well-sized files) and a partition holding a third of all rows is still
    split over many tasks. ``df`` should be cheap to re-read (staged): the
    range bounds are sampled from it. Existing partitions not in ``df`` are
    kept (dynamic partition overwrite)."""
    order = [partition_col] + [k for k in keys if k != partition_col]
    (df.repartitionByRange(*order).write.mode(mode)
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))


def upsert_partitions(spark: SparkSession, incoming: DataFrame, path: str,
                      keys: list[str], partition_col: str = "dt") -> None:
    """Upsert ``incoming`` (unique on ``keys``, which include
    ``partition_col``) into the parquet table at ``path``.

    Deletes are stored as rows (tombstones, e.g. a ``deleted`` flag that
    readers filter): a partition left without rows would not be rewritten
    by a dynamic partition overwrite.

    ``incoming`` is staged once; the touched-partition probe, the anti join
    and the merge all read the staged copy. The merge is staged again so
    the final overwrite never reads the partitions it replaces.
    """
    with staged(spark, incoming, "upsert-incoming") as incoming:
        upsert_staged(spark, incoming, path, keys, partition_col)


def upsert_staged(spark: SparkSession, incoming: DataFrame, path: str,
                  keys: list[str], partition_col: str = "dt") -> None:
    """:func:`upsert_partitions` for rows that are a staged copy already."""
    if not table_exists(spark, path):
        write_clustered(incoming, path, partition_col, keys)
        return
    stored = touched_partitions(read_table(spark, path, incoming.schema), incoming,
                                partition_col)
    kept = stored.join(incoming.select(*keys), keys, "left_anti")
    with staged(spark, kept.unionByName(incoming), "upsert-merged") as merged:
        write_clustered(merged, path, partition_col, keys)


def append_partitions(incoming: DataFrame, path: str, partition_col: str = "dt") -> None:
    """Append rows whose keys are known to be new (e.g. after an anti join
    against the stored table): no stored partition is rewritten."""
    (incoming.write.mode("append").partitionBy(partition_col).parquet(path))


def compact_partitions(spark: SparkSession, path: str, schema, partition_col: str,
                       keys: list[str], values: list | None = None) -> None:
    """Rewrite partitions of a table (``values``, default all) as few
    range-clustered files with the same rows: appends from many
    micro-batches leave many small files behind. The rows are staged first,
    so the overwrite never reads the files it replaces."""
    df = read_table(spark, path, schema)
    if values is not None:
        df = df.where(F.col(partition_col).isin(values))
    with staged(spark, df, "compact") as copy:
        write_clustered(copy, path, partition_col, keys)
