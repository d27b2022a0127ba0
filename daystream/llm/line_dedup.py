"""Removing lines that many documents share (built-ins only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daystream.llm.spans import LAST, uid
from daystream.llm.store import stage

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Lines of a bitmap word.
BITS = 62
#: Parts that the documents of a line's hash are dealt to.
SHARDS = 64


def _rows(docs: DataFrame, *more) -> DataFrame:
    """(doc, uid, lines): ``doc`` orders documents (null last), ``uid`` names the pair of id and text."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), uid().alias("uid"),
        F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n", -1).alias("lines"), *more)


def line_hashes(docs: DataFrame, least_chars: int = 40) -> DataFrame:
    """(h1, h2, doc, uid, pos), one row for each line whose key has ``least_chars`` code points.

    The key is the line without blanks at its ends, A-Z in lower case; its
    name is a pair of independent 64-bit hashes, so the text itself never moves.
    """
    lines = _rows(docs).select("doc", "uid", F.posexplode("lines").alias("pos", "line"))
    keys = lines.select("doc", "uid", "pos", F.btrim("line", F.lit(BLANKS)).alias("key")).filter(F.length("key") >= least_chars)
    key = F.translate("key", UPPER, LOWER)
    return keys.select(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2"), "doc", "uid", "pos")


def line_bitmaps(docs: DataFrame, least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """Which lines of which documents go: (doc, uid, n_dropped, dropped), only documents that lose one.

    ``dropped`` is a compressed bitmap: the words of 62 lines that have a bit
    set, in order, as (word, mask); lines without a bit are kept.

    The hashes of all long lines are range-partitioned by (hash, shard), with a
    secondary sort by document and position; a streaming pass over the sorted
    rows (``lag``) marks the first occurrence in each document. A shard is a
    part of the documents, so a line that a third of all documents hold is 64
    sorted stretches and not one; each stretch leaves one row (documents, last
    document), at most 64 a hash, and their sums tell the hashes that
    ``least_docs`` documents hold. Those go back to the hash rows by (hash,
    shard), and every row of a document other than the last sets a bit.
    """
    shard = F.pmod(F.xxhash64("doc"), F.lit(SHARDS)).cast("int").alias("shard")
    rows = stage(line_hashes(docs, least_chars), "lines").select("*", shard)
    stream = Window.partitionBy("h1", "h2", "shard").orderBy("doc", "pos")
    first = F.when(F.lag("doc").over(stream) == F.col("doc"), 0).otherwise(1)
    heads = (rows.repartitionByRange("h1", "h2", "shard").withColumn("first", first)
             .groupBy("h1", "h2", "shard").agg(F.sum("first").alias("n"), F.max("doc").alias("last")))
    shared = (heads.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("last").alias("last"), F.collect_list("shard").alias("shards"))
              .filter(F.col("n") >= least_docs).select("h1", "h2", "last", F.explode("shards").alias("shard")))
    gone = rows.join(shared, ["h1", "h2", "shard"]).filter("doc <> last")
    words = (gone.groupBy("doc", "uid", F.floor(F.col("pos") / BITS).cast("int").alias("word"))
             .agg(F.bit_or(F.expr(f"shiftleft(1L, pos % {BITS})")).alias("mask")))
    out = words.groupBy("doc", "uid").agg(F.sum(F.bit_count("mask")).cast("long").alias("n_dropped"),
                                          F.sort_array(F.collect_list(F.struct("word", "mask"))).alias("dropped"))
    return stage(out, "line-bitmaps")


def line_dedup(docs: DataFrame, least_chars: int = 40, least_docs: int = 5, extra: tuple = ()) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) without the lines that many documents share.

    A line's key is the line without [space, 0x09-0x0D] at both ends and A-Z in
    lower case. A key of at least ``least_chars`` code points that
    ``least_docs`` documents (distinct doc_id) hold loses all its lines except
    those in the largest doc_id that holds it. Returns doc_id, n_lines (before
    dropping), n_dropped, text (the other lines joined by a line feed) and,
    with ``extra``, a struct ``row`` of those columns.

    Null and empty texts are one empty line. Rows with one doc_id are one
    document when documents are counted, and each row loses its own lines;
    equal rows get equal results. Rows with a null doc_id are one document,
    after all others. An empty table gives an empty result; other columns are
    not read. A very long text is one row of its task, its bitmap 1 bit a line
    at most. Texts move once, to meet their bitmaps; before that only 28 bytes
    a long line.
    """
    maps = line_bitmaps(docs, least_chars, least_docs)
    # the words before and between those that are set, so that the word of a line is found by its number
    gap = lambda e, i: e["word"] - F.coalesce(F.get("dropped", i - 1)["word"], F.lit(-1)) - 1
    dense = F.flatten(F.transform("dropped", lambda e, i: F.concat(F.array_repeat(F.lit(0).cast("long"), gap(e, i)), F.array(e["mask"]))))
    maps = maps.select(F.col("doc").alias("m_doc"), F.col("uid").alias("m_uid"), "n_dropped", dense.alias("mask"))
    more = [F.struct(*extra).alias("row")] if extra else []
    rows = _rows(docs, F.col("doc_id").cast("long").alias("doc_id"), *more)
    # bitmaps grow with the corpus; the plan is the same at every size
    out = rows.join(maps.hint("merge"), (F.col("doc") == F.col("m_doc")) & (F.col("uid") == F.col("m_uid")), "left")
    kept = F.expr(f"""filter(lines, (x, i) -> shiftright(coalesce(get(mask, cast(i div {BITS} as int)), 0L), i % {BITS}) & 1L = 0L)""")
    return out.select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
                      F.array_join(F.when(F.col("mask").isNull(), F.col("lines")).otherwise(kept), "\n").alias("text"), *[F.col("row") for _ in more])


def op12_line_dedup(spark, sf_dir: str) -> DataFrame:
    from daystream.session import read_table
    out = line_dedup(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


#: The same rows by the definition, in DuckDB SQL.
OP12_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM docs),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
shared AS (SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT k.*, s.last IS NOT NULL AND k.doc_id <> s.last AS gone FROM keyed k LEFT JOIN shared s USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r
"""
