"""Word-level substring dedup on a compacted de Bruijn graph."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystream.llm import spans as S
from daystream.llm import text as T
from daystream.llm.store import parts_for, stage

WIDTH, K = 13, 5


def word_units(data, off):
    start, end, row = T.words(data, off)
    uoff = np.r_[0, np.cumsum(T.row_counts(row, len(off) - 1))]
    return uoff, T.span_hash(data, start, end, 0), T.span_hash(data, start, end, 1)


def _compact(found: DataFrame, width: int) -> DataFrame:
    """Settled runs of a document that follow one another in it and in one source, as one path: (uid, lo, words, source, at)."""
    def run(batches):
        for b in batches:
            out = [[] for _ in range(5)]
            for uid, blobs in zip(b.column("uid").to_pylist(), b.column("spans")):
                r = np.frombuffer(b"".join(x.as_buffer() for x in blobs.values), S.SOURCED)
                r = r[np.argsort(r["lo"], kind="stable")]
                lo, end = r["lo"].astype(np.int64), r["lo"].astype(np.int64) + r["count"]
                shift = r["at"].astype(np.int64) - lo
                new = np.r_[True, (r["source"][1:] != r["source"][:-1]) | (shift[1:] != shift[:-1]) | (lo[1:] > end[:-1])]
                cut = np.flatnonzero(new)
                for o, v in zip(out, (np.full(len(cut), uid), lo[cut], np.maximum.reduceat(end, cut) - lo[cut] + width - 1, r["source"][cut], r["at"][cut])):
                    o.append(v)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o).astype(np.int64)) for o in out], ["uid", "lo", "words", "source", "at"])

    return S.by_document(found, 0).mapInArrow(run, "uid long, lo long, words long, source long, at long")


def _digest(raw: bytes, start, end) -> bytes:
    return hashlib.sha256(b" ".join([raw[x:y] for x, y in zip(start.tolist(), end.tolist())])).digest()[:16]


def _slices(joined: DataFrame) -> DataFrame:
    """Digests of the source slices that paths point to: (source, at, words, digest)."""
    def run(batches):
        for b in batches:
            for part in T.pieces(pa.Table.from_batches([b]), "text"):
                asked = [x for c in part.column("slices").chunks for x in c]
                if not any(x.is_valid for x in asked):
                    continue
                data, off = T.buffers(part.column("text"))
                start, end, row = T.words(data, off)
                uoff = np.r_[0, np.cumsum(T.row_counts(row, len(off) - 1))]
                raw, out = data.tobytes(), [[] for _ in range(4)]
                for i, (uid, x) in enumerate(zip(part.column("uid").to_pylist(), asked)):
                    for s in x.as_py() or ():
                        a = uoff[i] + s["at"]
                        for o, v in zip(out, (uid, s["at"], s["words"], _digest(raw, start[a:a + s["words"]], end[a:a + s["words"]]))):
                            o.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out[:3]] + [pa.array(out[3], pa.binary())], ["source", "at", "words", "digest"])

    return joined.mapInArrow(run, "source long, at long, words long, digest binary")


def _edges(joined: DataFrame, width: int, buckets: int) -> DataFrame:
    """The windows of the asked runs as edges of their own, packed by window hash."""
    def run(batches):
        held, size = [], 0
        for b in batches:
            for part in T.pieces(pa.Table.from_batches([b]), "text"):
                data, off = T.buffers(part.column("text"))
                uoff, first, second = word_units(data, off)
                pre, pre2 = S.prefix(first, 0), S.prefix(second, 1)
                rank, uid = part.column("rank").to_numpy(), part.column("uid").to_numpy()
                for i, blobs in enumerate(x for c in part.column("spans").chunks for x in c):
                    if not blobs.is_valid:
                        continue
                    rec = np.frombuffer(b"".join(x.as_buffer() for x in blobs.values), S.SPAN)
                    lo = T.ranges(rec["lo"].astype(np.int64), rec["count"].astype(np.int64)) + uoff[i]
                    held.append((S.rolled(pre, lo, lo + width), S.rolled(pre2, lo, lo + width), np.full(len(lo), rank[i]),
                                 np.full(len(lo), uid[i]), lo - uoff[i], np.ones(len(lo), np.int64)))
                    size += len(lo)
                if size > 1 << 20:
                    yield from S.pack_by_bucket(*(np.concatenate(x) for x in zip(*held)), buckets)
                    held, size = [], 0
        if held:
            yield from S.pack_by_bucket(*(np.concatenate(x) for x in zip(*held)), buckets)

    return joined.mapInArrow(run, S.PACKED)


def substring_dedup(docs: DataFrame, width: int = WIDTH, k: int = K, with_text: bool = True) -> DataFrame:
    """Remove words of ``docs`` (doc_id, text) that a window repeats from an earlier document.

    A window is ``width`` consecutive words; each word covered by a window
    whose word sequence also starts in a document with a smaller doc_id goes.
    Windows are judged on the input. Returns per row doc_id, n_words,
    n_removed, kept_sha256 and, if ``with_text``, text (the kept words joined
    by one space).

    The token k-mers are edges of a de Bruijn graph. Its nonbranching paths are
    compacted around anchor k-mers (see :mod:`spans`): copies of a path are
    settled as one edge, with the document and word where its first copy
    starts. Edges that follow one another in a document and in one source are
    joined to long paths, and each is verified against the words at the
    source's coordinates. Where the graph branches, the windows themselves become
    edges, equal if two independent 64-bit hashes are.

    Null and empty texts have no words; texts shorter than a window lose
    nothing; a repeat within one document removes nothing; rows that share a
    doc_id don't remove each other; null doc_ids come after all others. An
    empty table gives an empty result. Other columns are not read.
    """
    rows = S.ranked(docs)
    size, _ = parts_for(rows, "text", 1)
    spark = docs.sparkSession
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // (8 << 20)))
    hot = S.common(rows, word_units, k)
    found = stage(S.settle(S.scan(rows, word_units, width, k, buckets, hot, sources=True), True, buckets, sources=True), "edges")
    paths = stage(_compact(found, width), "paths")
    # the distinct slices of a source: few even if a third of all documents point to it
    slices = (paths.groupBy("source", "at", "words").count().groupBy(F.col("source").alias("uid"))
              .agg(F.collect_list(F.struct("at", "words")).alias("slices")))
    asked = S.by_document(found, 1).join(slices, "uid", "full")
    # both readers below see the same join, so its exchanges are made once
    joined = rows.join(asked, "uid").select("uid", "rank", "text", "spans", "slices")
    checked = (paths.join(_slices(joined), ["source", "at", "words"])
               .groupBy("uid").agg(F.collect_list(F.struct("lo", "words", "digest")).alias("paths")))
    finer = S.by_document(S.settle(_edges(joined, width, buckets), False, buckets))
    spans = finer.join(checked, "uid", "full")

    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["text"] * with_text

    def cut(batches):
        for b in batches:
            for part in T.pieces(pa.Table.from_batches([b]), "text"):
                data, off = T.buffers(part.column("text"))
                start, end, row = T.words(data, off)
                uoff = np.r_[0, np.cumsum(T.row_counts(row, len(off) - 1))]
                blobs = [x for c in part.column("spans").chunks for x in c]
                long = part.column("paths").to_pylist()
                n, gone, sha, kept = [], [], [], []
                raw = data.tobytes()
                for i in range(part.num_rows):
                    s, e = start[uoff[i]:uoff[i + 1]], end[uoff[i]:uoff[i + 1]]
                    if blobs[i].is_valid or long[i]:
                        sp = S.spans_of(blobs[i].values if blobs[i].is_valid else None)
                        same = np.array([(p["lo"], p["lo"] + p["words"]) for p in long[i] or ()
                                         if _digest(raw, s[p["lo"]:p["lo"] + p["words"]], e[p["lo"]:p["lo"] + p["words"]]) == p["digest"]],
                                        np.int64).reshape(-1, 2)
                        keep = ~T.covered(len(s), np.r_[sp[:, 0], same[:, 0]], np.r_[sp[:, 0] + sp[:, 1] + width - 1, same[:, 1]])
                        left = b" ".join([raw[x:y] for x, y in zip(s[keep].tolist(), e[keep].tolist())])
                        gone.append(int(len(s) - keep.sum()))
                    else:
                        left = b" ".join(raw[off[i]:off[i + 1]].split())
                        gone.append(0)
                    n.append(len(s))
                    sha.append(hashlib.sha256(left).hexdigest())
                    if with_text:
                        kept.append(left.decode("utf-8", "replace"))
                cols = [part.column("doc_id").combine_chunks(), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())]
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(c.chunks) if isinstance(c, pa.ChunkedArray) else c for c in cols]
                                                 + ([pa.array(kept, pa.string())] if with_text else []), names)

    return rows.join(spans, "uid", "left").select("doc_id", "text", "spans", "paths").mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", text string" * with_text)


def op10_substring_dedup(spark, sf_dir: str) -> DataFrame:
    from daystream.session import read_table
    return substring_dedup(read_table(spark, sf_dir, "documents"), with_text=False)


OP10_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
win AS (SELECT doc_id, i, hash(words[i:i + 12]) AS a, md5(array_to_string(words[i:i + 12], ' ')) AS b
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w)),
first AS (SELECT b, min(doc_id) AS f FROM win GROUP BY b),
hit AS (SELECT doc_id, i FROM win JOIN first USING (b) WHERE f < doc_id),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM hit, range(0, 13) t(j)),
word AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
