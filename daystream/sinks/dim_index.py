"""Point lookups in the dimension store.

The store (:mod:`daystream.sinks.dims`) keeps a folder for every batch. The
index holds the rows of many folders by key hash: *levels*, each folded from
the batch folders since the one before, and a *base* folded from base and
levels when there are ``max_levels``. Within a table a level is split into
buckets by the hash of the key, one sorted file each, so a batch of ids opens the
files of its buckets in base and levels and the few batch folders that aren't
folded yet, whatever the size of the dimension.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daystream.sinks.dims import DIM_COLS, DIM_SCHEMA, current
from daystream.sinks.manifest import commit, read_manifest
from daystream.sinks.upsert import list_folders

#: A level's buckets for each table; more of them for dimensions of very many rows.
BUCKETS = 64


def bucket_of(id_col, buckets: int = BUCKETS):
    return F.pmod(F.xxhash64(id_col), F.lit(buckets)).cast("int")


def _batches(spark: SparkSession, dims_path: str, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], DIM_SCHEMA).select(*DIM_COLS)
    return spark.read.schema(DIM_SCHEMA).option("basePath", dims_path).parquet(*folders).select(*DIM_COLS)


def _level(spark: SparkSession, folder: str, table: str | None = None, buckets: list[int] = ()) -> DataFrame:
    """Rows of a level, or of some buckets of one table (only their folders are listed and read)."""
    r = spark.read.schema(DIM_SCHEMA + ", bucket int").option("basePath", folder)
    if table is None:
        return r.parquet(folder).select(*DIM_COLS)
    mine = [f for f in list_folders(spark, f"{folder}/table={table}", 1) if int(f.rsplit("bucket=", 1)[-1]) in set(buckets)]
    return r.parquet(*mine).select(*DIM_COLS) if mine else spark.createDataFrame([], DIM_SCHEMA).select(*DIM_COLS)


def _unfolded(spark: SparkSession, dims_path: str, manifest: dict) -> list[str]:
    folded = set(manifest.get("folded", []))
    return [f for f in list_folders(spark, dims_path, 2) if "/".join(f.split("/")[-2:]) not in folded]


def fold(spark: SparkSession, dims_path: str, index_path: str, max_levels: int = 8, buckets: int = BUCKETS) -> int:
    """Fold the batch folders that aren't in the index yet into a new level.

    With ``max_levels`` there already, base, levels and batches become a new base instead.
    The new level exists for readers from the manifest's switch on; what it
    replaces stays for readers that hold it. Returns the folders folded.
    """
    number, m = read_manifest(spark, index_path)
    new = _unfolded(spark, dims_path, m)
    if not new:
        return 0
    rows = _batches(spark, dims_path, new)
    levels, name = m.get("levels", []), uuid.uuid4().hex[:12]
    whole = len(levels) >= max_levels
    if whole:
        for old in levels:
            rows = rows.unionByName(_level(spark, f"{index_path}/{old}"))
    (current(rows).withColumn("bucket", bucket_of("id", buckets)).repartition("table", "bucket")
     .sortWithinPartitions("table", "bucket", "id").write.partitionBy("table", "bucket").parquet(f"{index_path}/{name}"))
    commit(spark, index_path, number + 1, {
        "levels": [name] if whole else [*levels, name], "buckets": buckets,
        "folded": sorted({*m.get("folded", []), *("/".join(f.split("/")[-2:]) for f in new)})})
    return len(new)


def lookup_rows(spark: SparkSession, dims_path: str, index_path: str, table: str, ids: DataFrame) -> DataFrame:
    """Stored rows of ``table`` that may be those of ``ids`` (one column): from
    the buckets of the ids in every level, and from batches not folded yet."""
    _, m = read_manifest(spark, index_path)
    key = ids.columns[0]
    wanted = ids.select(F.col(key).cast("string").alias("id")).where("id is not null").distinct()
    buckets = m.get("buckets", BUCKETS)
    mine = sorted(r[0] for r in wanted.select(bucket_of("id", buckets)).distinct().collect())  # at most ``buckets`` rows
    rows = _batches(spark, dims_path, _unfolded(spark, dims_path, m)).where(F.col("table") == table)
    for name in m.get("levels", []):
        rows = rows.unionByName(_level(spark, f"{index_path}/{name}", table, mine))
    return rows.join(wanted, "id", "left_semi").select(*DIM_COLS)


def lookup(spark: SparkSession, dims_path: str, index_path: str, table: str, ids: DataFrame) -> DataFrame:
    """Current rows of ``table`` for ``ids``, tombstones left out: the same rows as
    :func:`daystream.sinks.dims.read_dims` has for them."""
    return current(lookup_rows(spark, dims_path, index_path, table, ids)).where(~F.col("deleted"))


def dims_of(spark: SparkSession, dims_path: str, index_path: str, keys: dict[str, str]):
    """A function ``pages -> current dimension rows`` for the jobs: for each
    table, those that the column of the pages asks for."""
    def of(pages: DataFrame) -> DataFrame:
        parts = [lookup(spark, dims_path, index_path, t, pages.select(c)) for t, c in keys.items()]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    return of
