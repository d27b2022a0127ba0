"""Drawing the documents that look most like a target: importance resampling
on hashed word features (Gumbel top-k, so a draw without replacement)."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daystream.llm import text as T
from daystream.llm.crc import Joiner
from daystream.llm.store import stage

#: Bytes of text that share one dictionary.
BLOCK = 4 << 20
#: Letters in lower case; bytes that are in no word become the delimiter.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_CRC_BITS = 32


class Dictionary:
    """Aho-Corasick automaton of the distinct words of a block.

    An entry is a word between its two delimiters, and leads to its payload:
    the word's CRC-32 and bytes as one number. Neighbours share a delimiter, so
    a scan meets every word of a folded text exactly once, in order, and no
    word inside another.
    """

    def __init__(self, words):
        import ahocorasick
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        payload = []
        for w in words:
            raw = w.encode()
            self.machine.add_word(f" {w} ", len(payload))
            payload.append(zlib.crc32(raw) | len(raw) << _CRC_BITS)
        self.payload = np.array(payload, np.int64)
        if payload:
            self.machine.make_automaton()

    def scan(self, folded: str) -> np.ndarray:
        if not len(self.payload):
            return self.payload
        return self.payload[np.array([v for _, v in self.machine.iter(folded)], np.int64)]


def compose(payload: np.ndarray, row: np.ndarray, n: int, runs: int, buckets: int, joiner: Joiner) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of all runs of 1 to ``runs`` consecutive words of a row, joined by one space.

    ``payload`` and ``row`` list the words of ``n`` rows in order; a run's CRC
    comes from those of the run one shorter, the space and the next word.
    """
    crc, size = (payload & 0xFFFFFFFF).astype(np.uint32), payload >> _CRC_BITS
    space = np.uint32(zlib.crc32(b" "))
    found, owner, run = [crc], [row], crc
    for k in range(1, runs):
        same = row[k:] == row[:-k]
        if not same.any():
            break
        run = joiner.joined(joiner.joined(run[:-1], np.broadcast_to(space, len(run) - 1), 1), crc[k:], size[k:])
        found.append(run[same])
        owner.append(row[k:][same])
    every, owners = np.concatenate(found), np.concatenate(owner)
    order = np.argsort(owners, kind="stable") if len(found) > 1 else slice(None)
    return (every[order] % np.uint32(buckets)).astype(np.int64), owners[order]


def features(docs: DataFrame, runs: int = 1, buckets: int = 10_000, block: int = BLOCK) -> DataFrame:
    """(doc_id, text) -> (doc_id, n_words, n_features, buckets), one row a document.

    ``buckets`` holds the bucket of every feature as little-endian integers of
    16 or 32 bits. Each block of whole texts gets a dictionary of its own
    words, so no vocabulary is cut and a task holds that of one block.
    """
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def run(batches):
        joiner = Joiner()
        for b in batches:
            for part in T.pieces(b, "text", block):
                texts = [(t or b"").translate(FOLD).decode("utf-8", "replace") for t in part.column("text").cast(pa.binary()).to_pylist()]
                words = set()
                for t in texts:
                    words.update(t.split(" "))
                words.discard("")
                d = Dictionary(words)
                found = [d.scan(f" {t} ") for t in texts]
                n = np.array([len(x) for x in found], np.int64)
                row = np.repeat(np.arange(len(texts)), n)
                bucket, owner = compose(np.concatenate(found), row, len(texts), runs, buckets, joiner)
                m = T.row_counts(owner, len(texts))
                raw = bucket.astype(kind).tobytes()
                end = np.cumsum(m) * kind.itemsize
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n), pa.array(m),
                     pa.array([raw[i:j] for i, j in zip(np.r_[0, end[:-1]], end)], pa.binary())],
                    ["doc_id", "n_words", "n_features", "buckets"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_words long, n_features long, buckets binary")


def _numbers(column, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")
    data, off = T.buffers(column)
    return np.ascontiguousarray(data).view(kind), off // kind.itemsize


def bucket_counts(feats: DataFrame, buckets: int = 10_000) -> np.ndarray:
    """Features in each bucket over all rows; every task sends one row for each bucket it met."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            total += np.bincount(_numbers(b.column(0), buckets)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    rows = feats.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in rows.collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's share in the target over its share in the source, one added to each count."""
    k, s, t = float(len(source)), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000.0 * math.log(((b + 1.0) * (s + k)) / ((a + 1.0) * (t + k)))) for a, b in zip(source.tolist(), target.tolist())], np.int64)


def ranks(rows: DataFrame, order: list, key: str = "rank") -> DataFrame:
    """``rows`` with their number (1, 2, 3...) in ``order``, without a task that sees all of them.

    Rows are range-partitioned in that order, numbered in each partition and
    written; the sizes of the partitions (one row each) are prefix-summed.
    """
    schema = rows.schema

    def number(batches):
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(n, part, np.int64)), pa.array(np.arange(at, at + n))],
                                             [*schema.names, "_part", "_at"])
            at += n

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    placed = stage(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(number, fields + ", _part long, _at long"), "ranked")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = placed.groupBy("_part").agg(F.count("*").alias("n")).select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # one row for each shuffle partition: bounded by their number
    return placed.join(F.broadcast(base), "_part").select(*schema.names, (F.col("base") + F.col("_at") + 1).alias(key))


def resample(docs: DataFrame, target: DataFrame, runs: int = 1, buckets: int = 10_000, least_words: int = 20,
             percent: int = 10, seed: int = 2024) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its weight, and its rank if it is drawn.

    Words are runs of digits, letters and non-ASCII characters, A-Z in lower
    case; features all runs of 1 to ``runs`` words. A bucket's gain compares
    its share of all features of ``target`` (text) with that of ``docs``; a
    document's weight is the sum of the gains of its features, its score the
    weight and a Gumbel number that its id and ``seed`` fix. Of the N rows with
    at least ``least_words`` words, floor(``percent`` * N / 100) with the
    highest scores are drawn, ties to smaller ids.

    Texts are scanned once and their buckets staged; counting and scoring read
    those. Returns doc_id, n_features, weight, score, rank (null: not drawn).

    Null and empty texts have no feature and weight 0. Repeated rows are rows
    of their own; a null doc_id counts as the empty id and is ranked after
    all others of its score. Empty tables: an empty target has zero counts, an
    empty ``docs`` gives an empty result. Other columns are not read. A task
    holds one block of texts and its dictionary; a text longer than a block is a block.
    """
    feats = stage(features(docs, runs, buckets), "features")
    goal = features(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), runs, buckets)
    gain = gains(bucket_counts(feats, buckets), bucket_counts(goal, buckets))

    def weigh(batches):
        for b in batches:
            bucket, off = _numbers(b.column("buckets"), buckets)
            sums = np.r_[0, np.cumsum(gain[bucket])]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_words"), b.column("n_features"), pa.array(sums[off[1:]] - sums[off[:-1]])],
                                             ["doc_id", "n_words", "n_features", "weight"])

    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    # ``tie`` spreads equal rows over partitions
    scored = stage(feats.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long").select(
        "*", (F.col("weight") + noise).alias("score"), F.monotonically_increasing_id().alias("tie")), "scores")
    fit = scored.filter(F.col("n_words") >= least_words)
    most = percent * fit.count() // 100
    placed = ranks(fit, [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("tie")])
    drawn = placed.withColumn("rank", F.when(F.col("rank") <= most, F.col("rank")))
    out = ["doc_id", "n_features", "weight", "score", "rank"]
    rest = scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return drawn.select(out).unionByName(rest.select(out))


def op11_resample(spark, sf_dir: str) -> DataFrame:
    from daystream.session import read_table
    return resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark").select("text"))


#: The same rows in DuckDB SQL; the CRC of each distinct word is folded byte by byte.
OP11_SQL = r"""
WITH RECURSIVE steps(b, v, k) AS (
  SELECT range::BIGINT, range::BIGINT, 0 FROM range(256)
  UNION ALL SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM steps WHERE k < 8),
tab AS MATERIALIZED (SELECT list(v ORDER BY b) AS t FROM steps WHERE k = 8),
docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id,
  coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
goal AS (SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
uses AS MATERIALIZED (SELECT r, word, count(*) AS n FROM (SELECT r, unnest(w) AS word FROM docs) GROUP BY ALL),
words AS (SELECT DISTINCT word FROM uses UNION SELECT word FROM goal),
hexes AS (SELECT word, hex(encode(word)) AS h FROM words),
crcs AS MATERIALIZED (SELECT word, xor(4294967295, list_reduce(
    list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, (2 * i + 1)::BIGINT, 2))::BIGINT),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295::BIGINT)) % 10000 AS bucket FROM hexes, tab),
s AS (SELECT bucket, sum(n) AS s FROM uses JOIN crcs USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM goal JOIN crcs USING (word) GROUP BY bucket),
sums AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::DOUBLE AS big_s, (SELECT coalesce(sum(t), 0) FROM t)::DOUBLE AS big_t),
gain AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (big_s + 10000) / ((s::DOUBLE + 1) * (big_t + 10000)))) AS BIGINT) AS g
  FROM s LEFT JOIN t USING (bucket), sums),
weights AS (SELECT r, sum(n * g)::BIGINT AS weight FROM uses JOIN crcs USING (word) JOIN gain USING (bucket) GROUP BY r),
scored AS (SELECT r, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
  coalesce(weight, 0)::BIGINT + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id::VARCHAR), 1, 8))::BIGINT::DOUBLE + 0.5) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM docs LEFT JOIN weights USING (r)),
drawn AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id, n_features) AS rank FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score,
  CASE WHEN rank <= 10 * (SELECT count(*) FROM drawn) // 100 THEN rank END AS rank
FROM scored LEFT JOIN drawn USING (r)
"""
