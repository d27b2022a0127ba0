"""Staging in the shared folder and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daystream.session import scratch_path

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of an Arrow batch while a table is staged.
TEXTS = 2000


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once below ``spark.checkpoint.dir`` and read again.

    Cuts the lineage at a table that every executor can read, so a lost
    executor costs the tasks it held and not the work before the table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    # texts travel to Python workers in batches of rows: fewer of them while this runs
    rows = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(min(TEXTS, int(rows)) if int(rows) > 0 else TEXTS))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(BATCH_ROWS, rows)
    return spark.read.schema(df.schema).parquet(path)


def parts_for(df: DataFrame, column: str, target: int) -> tuple[int, int]:
    """(bytes of a column over all rows, parts of about ``target`` bytes)."""
    n = int(df.agg(F.sum(F.octet_length(column))).first()[0] or 0)
    return n, max(1, -(-n // target))


def components(spark: SparkSession, edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (src, dst long) -> (id, component_id).

    Each round lets every node's neighbours point at the smallest id seen
    (alternating "large star" and "small star" steps), so a path of length n
    needs about log n rounds. Nothing is gathered on the driver but one count
    a round. ``component_id`` is the smallest id of the component. Nodes
    without an edge are not returned. Each step pre-aggregates per task, so
    the star of a hot node isn't gathered into one.
    """
    e = edges.select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b")).filter("a <> b").distinct()
    e = stage(e, "edges")
    for _ in range(rounds):
        # large star: every larger neighbour is linked with the smallest one
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        big = (both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        # small star: every smaller neighbour and the node itself, with the smallest one
        big = stage(big.filter("a <> b").distinct(), "star")
        low2 = big.groupBy("a").agg(F.min("b").alias("m"))
        small = (big.join(low2, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
                 .unionByName(low2.select("a", F.col("m").alias("b"))))
        new = stage(small.distinct(), "star")
        # stars only: no node is both a leaf and a centre, and each leaf has one centre
        left = new.select(F.col("b").alias("a")).distinct().join(new, "a", "left_semi").limit(1).count()
        twice = new.groupBy("a").count().filter("count > 1").limit(1).count()
        e = new
        if not left and not twice:
            break
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("a").alias("id"), F.col("b").alias("component_id")).unionByName(
        e.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct())
