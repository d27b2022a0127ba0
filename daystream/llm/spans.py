"""Windows that start in an earlier document too: the shared part of the
byte-level and the word-level substring dedup.

Notation: a text is a row of units (bytes or words), a window is ``width``
consecutive units of one text, a k-mer ``k`` consecutive units. Every window
has one *anchor*: its k-mer with the smallest hash, the leftmost of equal ones.
Consecutive windows of a text with the same anchor form a *run*, and the units
that a run covers are its *path* around the anchor.

Equal windows have equal anchors, so it is enough to compare runs with the same
anchor k-mer. Of the documents that have the same path around an anchor, all
but the one with the smallest id have every window of the run in an earlier
document: those runs are settled by comparing paths. Where paths with the same
anchor differ (the graph branches there), the first document of each path is
kept for a finer comparison, window by window, which the two operators do in
their own way. Nothing is sampled: each window is in exactly one run.

A k-mer that a large share of all documents have (a licence line, a common
phrase) would bring very many paths to one task. :func:`common` finds those that
are more than a ``COMMON``-th of all k-mers, fewer than ``COMMON`` of them; a
window then takes its smallest k-mer among the others, and a common one only if
it has no other, that is inside a shared passage, where paths are alike: at the
passage's edges the k-mers that reach out of it are as rare as what surrounds
it. Which k-mers are common is a property of the corpus, so equal windows still
have equal anchors.

What moves is about 0.06 runs for a byte and 0.2 for a word, packed by hash
bucket, with runs that a task has settled on its own (a copy beside its
original) left out, so an anchor that a third of all documents share is sent
once for each task and not once for each document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystream.llm import text as T

LAST = (1 << 63) - 1
#: A k-mer is common if it is more than one in so many of all k-mers.
COMMON = 50_000
PACKED = "bucket long, key binary, path binary, rank binary, uid binary, n binary, lo binary, count binary"
FOUND = "uid long, kind int, spans binary"
#: One span: first unit, number of windows, anchor (only for kind 1).
SPAN = np.dtype([("lo", "<i4"), ("count", "<u2"), ("anchor", "<u8")])
#: A settled span with its source: the document and unit where the first copy starts.
SOURCED = np.dtype([("lo", "<i4"), ("count", "<i4"), ("source", "<i8"), ("at", "<i4")])


def uid(text="text"):
    """Names the pair of id and text."""
    return F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.coalesce(F.col(text).cast("string"), F.lit("")))


def ranked(docs: DataFrame, extra: tuple = ()) -> DataFrame:
    """(uid, rank, doc_id, text): ``rank`` orders documents (doc_id, null last); ``extra`` columns are kept in ``row``.

    ``uid`` names the pair of id and text, so that rows that share an id but
    not a text stay apart, and equal rows get equal results.
    """
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    more = [F.struct(*extra).alias("row")] if extra else []
    return docs.select(uid().alias("uid"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("rank"),
                       F.col("doc_id").cast("long").alias("doc_id"), body.alias("text"), *more)


def prefix(units: np.ndarray, which: int) -> tuple[np.ndarray, np.ndarray]:
    """What :func:`rolled` needs to hash any range of ``units`` (64-bit values)."""
    n = len(units)
    p, q = T._powers(n + 1, which)
    s = np.zeros(n + 1, np.uint64)
    np.cumsum(units * p[:n], out=s[1:])
    return s, q


def rolled(pre, start, end) -> np.ndarray:
    s, q = pre
    if isinstance(start, slice):
        return T.mix((s[end] - s[start]) * q[start])
    return T.mix((s[end] - s[start]) * q[start])


def demoted(h: np.ndarray, hot) -> np.ndarray:
    """k-mer hashes for choosing the smallest, the common ones (``hot``: sorted hashes, sieve) after all others."""
    h = h >> np.uint64(1)
    if hot is None or not len(hot[0]):
        return h
    some = np.flatnonzero(hot[1][(h & np.uint64(len(hot[1]) - 1)).astype(np.int64)])
    at = np.searchsorted(hot[0], h[some])
    at[at == len(hot[0])] = 0
    h[some[hot[0][at] == h[some]]] |= np.uint64(1) << np.uint64(63)
    return h


def hot_set(hashes: np.ndarray):
    hashes = np.sort(hashes)
    sieve = np.zeros(1 << 18, bool)
    sieve[(hashes & np.uint64(len(sieve) - 1)).astype(np.int64)] = True
    return hashes, sieve


def common(rows: DataFrame, units: Callable, k: int, batch: int = 4 << 20):
    """The common k-mers, for :func:`runs`.

    A task reports the k-mers that occur at least 16 times in a batch of texts;
    what it leaves out is too little to make one common.
    """
    def run(batches):
        held, size = [], 0
        for b in batches:
            for part in T.pieces(pa.Table.from_batches([b]), "text"):
                data, off = T.buffers(part.column("text"))
                uoff, first, _ = units(data, off)
                n = len(first)
                if n >= k:
                    h = rolled(prefix(first, 0), slice(0, n - k + 1), slice(k, n + 1)) >> np.uint64(1)
                    row = np.repeat(np.arange(len(uoff) - 1, dtype=np.int32), np.diff(uoff))
                    held.append(h[row[:n - k + 1] == row[k - 1:]])
                size += len(data)
                if size >= batch:
                    if held:
                        yield count(held)
                    held, size = [], 0
        if held:
            yield count(held)

    def count(held):
        h = np.concatenate(held)
        cell = (h & np.uint64((1 << 22) - 1)).astype(np.int64)
        u, n = np.unique(h[np.bincount(cell, minlength=1 << 22)[cell] >= 16], return_counts=True)
        many = n >= 16
        # hash 0 with kind 0 carries the number of all k-mers
        return pa.RecordBatch.from_arrays([pa.array(np.r_[0, np.ones(many.sum(), np.int64)]), pa.array(np.r_[np.uint64(0), u[many]].view(np.int64)),
                                           pa.array(np.r_[len(h), n[many]])], ["kind", "hash", "n"])

    from daystream.llm.store import stage
    found = stage(rows.select("text").mapInArrow(run, "kind long, hash long, n long").groupBy("kind", "hash").agg(F.sum("n").alias("n")), "anchors")
    total = found.filter("kind = 0").agg(F.sum("n")).first()[0] or 0
    top = found.filter((F.col("kind") == 1) & (F.col("n") * COMMON > total)).select("hash").collect()  # fewer than COMMON rows
    return hot_set(np.array([r[0] for r in top], np.int64).view(np.uint64))


def runs(pre, off: np.ndarray, width: int, k: int, hot=None):
    """Runs of all texts: (first window, number of windows, anchor position), as positions in the units."""
    n = int(off[-1])
    z = np.zeros(0, np.int64)
    if n < width:
        return z, z, z
    h = demoted(rolled(pre, slice(0, n - k + 1), slice(k, n + 1)), hot)
    bits = np.uint64(max(1, n.bit_length()))
    low = T.slides((h >> bits << bits) | np.arange(len(h), dtype=np.uint64), width - k + 1, np.minimum)
    at = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    inside = np.flatnonzero(row[:n - width + 1] == row[width - 1:])
    if not len(inside):
        return z, z, z
    at = at[inside]
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return inside[first], np.diff(np.r_[first, len(at)]), at[first]


def pack_by_bucket(anchor, path, rank, uid, lo, count, buckets: int) -> Iterator[pa.RecordBatch]:
    """Entries as one row a bucket; the documents' columns are run-length coded."""
    b = (anchor % np.uint64(buckets)).astype(np.int64)
    o = np.lexsort((lo, uid, b))
    anchor, path, rank, uid, lo, count, b = (x[o] for x in (anchor, path, rank, uid, lo, count, b))
    cut = np.flatnonzero(np.r_[True, b[1:] != b[:-1]]) if len(b) else np.zeros(0, np.int64)
    key = np.ascontiguousarray((anchor // np.uint64(buckets))).view(np.uint8).reshape(-1, 8)
    cols = [[] for _ in range(8)]
    for s, e in zip(cut, np.r_[cut[1:], len(b)]):
        u = np.flatnonzero(np.r_[True, uid[s + 1:e] != uid[s:e - 1]]) + s
        for c, v in zip(cols, (int(b[s]), key[s:e, :6].tobytes(), path[s:e].tobytes(), rank[u].tobytes(), uid[u].tobytes(),
                               np.diff(np.r_[u, e]).astype("<i4").tobytes(), lo[s:e].astype("<i4").tobytes(),
                               count[s:e].astype("<u2").tobytes())):
            c.append(v)
    if cols[0]:
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64())] + [pa.array(c, pa.binary()) for c in cols[1:]],
                                         ["bucket", "key", "path", "rank", "uid", "n", "lo", "count"])


def unpack(table: pa.Table):
    """(key, path, rank, uid, lo, count) of all rows of one bucket."""
    def joined(name, kind):
        return np.frombuffer(b"".join(x.as_buffer() for c in table.column(name).chunks for x in c), kind)
    raw = joined("key", np.uint8).reshape(-1, 6)
    key = np.zeros((len(raw), 8), np.uint8)
    key[:, :6] = raw
    n = joined("n", "<i4")
    return (key.view("<u8").ravel(), joined("path", "<u8"), np.repeat(joined("rank", "<i8"), n), np.repeat(joined("uid", "<i8"), n),
            joined("lo", "<i4").astype(np.int64), joined("count", "<u2"))


def leaders(anchor, path, rank, uid, lo):
    """For each entry, that of the smallest rank (then uid, lo) with the same anchor and path."""
    o = np.lexsort((lo, uid, rank, path, anchor))
    a, p = anchor[o], path[o]
    new = np.r_[True, (a[1:] != a[:-1]) | (p[1:] != p[:-1])] if len(a) else np.zeros(0, bool)
    out = np.zeros(len(a), np.int64)
    out[o] = o[np.flatnonzero(new)][np.cumsum(new) - 1]
    return out


def found_rows(uid, kind: int, lo, count, anchor=None, source=None, at=None) -> Iterator[pa.RecordBatch]:
    """One row a document with its spans: (lo, count), with the anchor (kind 1) or with the source."""
    if not len(uid):
        return
    o = np.argsort(uid, kind="stable")
    rec = np.zeros(len(o), SPAN)
    rec["lo"], rec["count"] = lo[o], count[o]
    if anchor is not None:
        rec["anchor"] = anchor[o]
    if source is not None:
        rec = np.zeros(len(o), SOURCED)
        rec["lo"], rec["count"], rec["source"], rec["at"] = lo[o], count[o], source[o], at[o]
    raw = rec.tobytes() if kind or source is not None else np.ascontiguousarray(np.stack([rec["lo"].astype("<i4"), rec["count"].astype("<i4")], 1)).tobytes()
    step = len(raw) // len(o)
    u = uid[o]
    cut = np.flatnonzero(np.r_[True, u[1:] != u[:-1]])
    ends = np.r_[cut, len(u)].astype(np.int64) * step
    blob = pa.Array.from_buffers(pa.large_binary(), len(cut), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw)]).cast(pa.binary())
    yield pa.RecordBatch.from_arrays([pa.array(u[cut]), pa.array(np.full(len(cut), kind, np.int32)), blob], ["uid", "kind", "spans"])


def scan(rows: DataFrame, units: Callable, width: int, k: int, buckets: int, hot=None, sources: bool = False,
         batch: int = 6 << 20) -> DataFrame:
    """Pass one: the runs of all texts, packed by bucket of their anchor.

    ``units(data, off)`` gives (unit offsets of the rows, two arrays of 64-bit
    unit values). Runs settled within a task's ``batch`` bytes travel as rows
    of bucket -1 - x, whose ``path`` holds the spans as they are.
    """
    def run(batches):
        held, size, seen = [], 0, 0
        for b in batches:
            for part in T.pieces(pa.Table.from_batches([b]), "text"):
                data, off = T.buffers(part.column("text"))
                uoff, first, second = units(data, off)
                pre, pre2 = prefix(first, 0), prefix(second, 1)
                lo, count, at = runs(pre, uoff, width, k, hot)
                if len(lo):
                    row = np.searchsorted(uoff, lo, side="right") - 1
                    # rows without units share an offset: the last of equal offsets is the row that has them
                    anchor = rolled(pre, at, at + k)
                    path = rolled(pre2, lo, lo + count + width - 1) ^ T.mix((at - lo).astype(np.uint64) * np.uint64(65536) + count.astype(np.uint64))
                    rank, uid = part.column("rank").to_numpy(), part.column("uid").to_numpy()
                    held.append((anchor, path, rank[row], uid[row], lo - uoff[row], count))
                size += len(data)
                if size >= batch and held:
                    seen += 1
                    yield from flush(held, seen)
                    held, size = [], 0
        if held:
            yield from flush(held, seen + 1)

    def flush(held, seen):
        anchor, path, rank, uid, lo, count = (np.concatenate(x) for x in zip(*held))
        lead = leaders(anchor, path, rank, uid, lo)
        first = rank == rank[lead]
        late = ~first
        yield from pack_by_bucket(anchor[first], path[first], rank[first], uid[first], lo[first], count[first], buckets)
        from_ = (uid[lead[late]], lo[lead[late]]) if sources else (None, None)
        for f in found_rows(uid[late], 0, lo[late], count[late], None, *from_):
            n = f.num_rows
            none = pa.array([b""] * n, pa.binary())
            # spread over the buckets, so that no reducer gets them all
            where = pc.subtract(pa.scalar(-1, pa.int64()), pa.array(np.mod(f.column("uid").to_numpy(), buckets)))
            yield pa.RecordBatch.from_arrays(
                [where, none, f.column("spans"), none, pa.array([int(x).to_bytes(8, "little", signed=True) for x in f.column("uid").to_numpy()], pa.binary()),
                 none, none, none], ["bucket", "key", "path", "rank", "uid", "n", "lo", "count"])

    return rows.select("uid", "rank", "text").mapInArrow(run, PACKED)


def settle(packed: DataFrame, branches: bool, buckets: int, sources: bool = False) -> DataFrame:
    """Pass two, by bucket: kind 0 are settled spans; kind 1 (if ``branches``)
    the runs of a path's first document where paths around an anchor differ."""
    def run(key, table):
        out = []
        if key[0].as_py() < 0:
            uid = np.frombuffer(b"".join(x.as_buffer() for c in table.column("uid").chunks for x in c), "<i8")
            return pa.table({"uid": pa.array(uid), "kind": pa.array(np.zeros(len(uid), np.int32)),
                             "spans": table.column("path").cast(pa.binary())})
        k, path, rank, uid, lo, count = unpack(table)
        o = np.argsort(k, kind="stable")
        s = k[o]
        many = np.zeros(len(s), bool)
        if len(s) > 1:
            same = s[1:] == s[:-1]
            many[1:] |= same
            many[:-1] |= same
        o = o[many]
        k, path, rank, uid, lo, count = (x[o] for x in (k, path, rank, uid, lo, count))
        lead = leaders(k, path, rank, uid, lo)
        first = rank == rank[lead]
        late = ~first
        from_ = (uid[lead[late]], lo[lead[late]]) if sources else (None, None)
        out += found_rows(uid[late], 0, lo[late], count[late], None, *from_)
        if branches and first.any():
            k, path, uid, lo, count = (x[first] for x in (k, path, uid, lo, count))
            q = np.lexsort((path, k))
            new_key = np.r_[True, k[q][1:] != k[q][:-1]]
            new_path = new_key | np.r_[True, path[q][1:] != path[q][:-1]]
            g = np.cumsum(new_key) - 1
            n_paths = np.bincount(g[new_path], minlength=g[-1] + 1)
            branch = q[n_paths[g] > 1]
            anchor = k[branch] * np.uint64(buckets) + np.uint64(key[0].as_py())
            out += found_rows(uid[branch], 1, lo[branch], count[branch], anchor)
        schema = pa.schema([("uid", pa.int64()), ("kind", pa.int32()), ("spans", pa.binary())])
        T.release()
        return pa.Table.from_batches(out, schema) if out else schema.empty_table()

    return packed.groupBy("bucket").applyInArrow(run, FOUND)


def by_document(found: DataFrame, kind: int | None = None) -> DataFrame:
    """(uid, spans): the spans of a document as an array of blobs."""
    if kind is not None:
        found = found.filter(F.col("kind") == kind)
    return found.groupBy("uid").agg(F.collect_list("spans").alias("spans"))


def spans_of(value) -> np.ndarray:
    """(lo, count) rows of kind 0 blobs (an Arrow list scalar's values)."""
    if value is None:
        return np.zeros((0, 2), np.int64)
    raw = b"".join(x.as_buffer() for x in value)
    return np.frombuffer(raw, "<i4").reshape(-1, 2).astype(np.int64)
