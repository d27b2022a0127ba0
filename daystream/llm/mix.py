"""Mixing sources to target weights by systematic sampling (built-ins only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """(source, source_size, n_docs) -> the same and ``target``.

    Sources by code point, null last, take ``weights`` in turn and share the
    sum of all sizes; a target stops at ``most`` times its source's size and
    the excess goes to the others by weight. The fixed point of that rule is
    water filling: with the sources ordered by size / weight, a prefix is
    capped and the rest shares what is left, so one ordered pass finds it.
    The windows without a key see one row per source.
    """
    w = F.array(*[F.lit(x).cast("long") for x in weights])
    order = Window.orderBy(F.col("source").asc_nulls_last())
    t = sizes.withColumn("weight", F.element_at(w, (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    by_room = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    after = by_room.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    t = (t.withColumn("total", F.sum("source_size").over(every))
         .withColumn("left", F.col("total") - most * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
         .withColumn("weights_left", F.sum("weight").over(after))
         .withColumn("capped", F.col("left") * F.col("weight") > most * F.col("source_size") * F.col("weights_left")))
    # the first source that is not capped fixes the share of one weight
    t = (t.withColumn("first_free", F.min(F.when(~F.col("capped"), F.struct(
            (F.col("source_size") / F.col("weight")).alias("r"), F.col("source").isNull().alias("n"), F.col("source").alias("s"),
            F.col("left").alias("left"), F.col("weights_left").alias("weights_left")))).over(every)))
    share = F.col("first_free.left") * F.col("weight") / F.col("first_free.weights_left")
    return t.select("source", "source_size", "n_docs", F.when(
        F.col("capped"), (most * F.col("source_size")).cast("double")).otherwise(share.cast("double")).alias("target"))


def _md5_number(text):
    """48 bits of the text's MD5 as a long; the same in any SQL engine."""
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def systematic_mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: int = 7,
                   bucket_rows: int = 4096) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, source) with its copies in the mix.

    Returns doc_id, source, row (a struct of all columns of the input), size,
    source_size, target, copies and taken. A document of a source with target t and size s is
    expected t / s times. The expected copies are prefix-summed within the
    source, one random offset in [0, 1) (a hash of source and ``seed``) is
    added, and a copy is emitted for each integer crossed, so a document has
    floor or ceil of t / s copies, at most ``most``.

    The order within a source is by random bucket (about ``bucket_rows`` rows
    each, so a hot source spreads over many) and then by size, which also makes
    every stretch of the sum take small and large documents alike. Because all
    documents of a source have the same expectation, the prefix sum before row
    i is i * t / s with an exact integer i = rows of earlier buckets + rank in
    the bucket: no chain of float additions, and reruns agree.

    Null text and empty text have size 0 and are taken 0 times. Null sources
    are one source. Repeated rows are rows of their own; rows equal in all
    columns used are interchangeable. An empty table gives an empty result.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    d = docs.select("doc_id", "source", F.struct(*docs.columns).alias("row"), size.alias("size"))
    return place(d, weights, most, seed, bucket_rows)


def place(sized: DataFrame, weights=(5, 2, 1), most=3, seed=7, bucket_rows=4096) -> DataFrame:
    """:func:`systematic_mix` for rows that have their ``size`` already."""
    extra = [c for c in sized.columns if c not in ("doc_id", "source", "size")]
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    t = targets(sizes, weights, most).withColumn("n_buckets", F.ceil(F.col("n_docs") / bucket_rows).cast("long"))
    key = _md5_number(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(str(seed))))
    # one row per source; joined as a broadcast or a shuffle, as its size says
    d = sized.withColumn("k", key).join(t.withColumnRenamed("source", "t_source"),
                                        F.col("source").eqNullSafe(F.col("t_source")), "left").drop("t_source")
    d = d.withColumn("bucket", F.pmod("k", F.col("n_buckets")))
    per = d.groupBy("source", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col("source").alias("p_source"), F.col("bucket").alias("p_bucket"),
                     F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"))
    in_bucket = Window.partitionBy("source", "bucket").orderBy("size", "k", "doc_id", *[F.xxhash64(c) for c in extra])
    d = d.withColumn("rank", F.row_number().over(in_bucket).cast("long") - 1)
    d = d.join(per, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("bucket") == F.col("p_bucket")), "left")
    i = F.col("rows_before") + F.col("rank")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = _md5_number(F.concat_ws(":", F.lit(str(seed)), F.col("source").isNull().cast("int").cast("string"),
                                     F.coalesce("source", F.lit("")))) / F.lit(float(1 << 48))
    copies = (F.floor((i + 1) * rate + offset) - F.floor(i * rate + offset)).cast("long")
    return d.withColumn("copies", copies).select(
        "doc_id", "source", *extra, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def op5_mix(spark, sf_dir: str) -> DataFrame:
    from daystream.session import read_table
    d = read_table(spark, sf_dir, "documents").select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    return place(d).select("doc_id", "size", "source_size", "target", "taken")


#: The same rows in DuckDB SQL, with the caps found by a recursive reshare
#: instead of the ordered pass above.
OP5_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sized GROUP BY source),
caps(step, source, source_size, n_docs, weight, capped) AS (
  SELECT 0, source, source_size, n_docs, weight, false FROM src
  UNION ALL
  SELECT step + 1, source, source_size, n_docs, weight, capped OR now
  FROM (SELECT *, (sum(source_size) OVER () - 3 * sum(CASE WHEN capped THEN source_size ELSE 0 END) OVER ()) * weight
               > 3 * source_size * sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () AS now FROM caps)
  QUALIFY bool_or(now AND NOT capped) OVER ()),
done AS (SELECT * FROM caps WHERE step = (SELECT max(step) FROM caps)),
target AS (
  SELECT source, source_size, n_docs, CASE WHEN capped THEN (3 * source_size)::DOUBLE ELSE
    ((sum(source_size) OVER () - 3 * sum(CASE WHEN capped THEN source_size ELSE 0 END) OVER ()) * weight)::DOUBLE
    / (sum(CASE WHEN capped THEN 0 ELSE weight END) OVER ())::DOUBLE END AS target FROM done),
keyed AS (
  SELECT s.*, t.source_size, t.target, t.n_docs,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':7'), 1, 12))::BIGINT AS k,
    ('0x' || substr(md5('7:' || (CASE WHEN s.source IS NULL THEN '1' ELSE '0' END) || ':' || coalesce(s.source, '')), 1, 12))::BIGINT
      / 281474976710656.0::DOUBLE AS u
  FROM sized s JOIN target t ON s.source IS NOT DISTINCT FROM t.source),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY k % (CAST(ceil(n_docs / 4096.0) AS BIGINT)), size, k, doc_id) - 1 AS i,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS r FROM keyed)
SELECT doc_id, size, source_size, target,
  (CAST(floor((i + 1) * r + u) AS BIGINT) - CAST(floor(i * r + u) AS BIGINT)) * size AS taken FROM ranked
"""
