"""Byte-level dedup of repeated strings by suffix arrays."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystream.llm import spans as S
from daystream.llm import text as T
from daystream.llm.lyndon import suffix_arrays
from daystream.llm.store import parts_for, stage

WIDTH, K = 50, 16
#: Symbols of all texts that one call sorts, and of one text at most (a larger group is split by more bytes).
BATCH, LARGEST = 1 << 19, 1 << 14
CUTS = "bucket long, anchor binary, rank binary, uid binary, lo binary, count binary, rel binary, body binary"


def byte_units(data, off):
    return off, T.BYTE_VALUE[0][data], T.BYTE_VALUE[1][data]


def _cuts(rows: DataFrame, asked: DataFrame, width: int, k: int, buckets: int, hot) -> DataFrame:
    """The bytes of the asked runs, packed by bucket of their anchor."""
    def run(batches):
        held, size = [], 0
        for b in batches:
            for part in T.pieces(pa.Table.from_batches([b]), "text"):
                data, off = T.buffers(part.column("text"))
                first = T.BYTE_VALUE[0][data]
                pre = S.prefix(first, 0)
                rank, uid = part.column("rank").to_numpy(), part.column("uid").to_numpy()
                blobs = [b"".join(x.as_buffer() for x in v.values) for c in part.column("spans").chunks for v in c]
                n = np.array([len(x) // S.SPAN.itemsize for x in blobs])
                rec = np.frombuffer(b"".join(blobs), S.SPAN)
                row = np.repeat(np.arange(len(n)), n)
                lo, count = rec["lo"].astype(np.int64) + off[row], rec["count"].astype(np.int64)
                # the anchor is the leftmost smallest k-mer of those that all windows of the run hold
                here, many = lo + count - 1, width - k + 2 - count
                at = T.ranges(here, many)
                h = S.demoted(S.rolled(pre, at, at + k), hot)
                bits = np.uint64(max(1, int(off[-1]).bit_length()))
                cut = np.r_[0, np.cumsum(many)[:-1]]
                low = np.minimum.reduceat((h >> bits << bits) | at.astype(np.uint64), cut)
                pos = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
                body = data[T.ranges(lo, count + width - 1)]
                held.append((rec["anchor"].astype(np.uint64), rank[row], uid[row], rec["lo"].astype(np.int64), count, pos - lo, body))
                size += len(body)
                if size > 8 << 20:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    def flush(held):
        anchor, rank, uid, lo, count, rel, body = (np.concatenate(x) for x in zip(*held))
        length = count + width - 1
        base = np.r_[0, np.cumsum(length)[:-1]]
        b = (anchor % np.uint64(buckets)).astype(np.int64)
        o = np.argsort(b, kind="stable")
        b = b[o]
        cut = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
        for s, e in zip(cut, np.r_[cut[1:], len(b)]):
            x = o[s:e]
            cols = [[int(b[s])], *[[y] for y in (anchor[x].tobytes(), rank[x].tobytes(), uid[x].tobytes(), lo[x].astype("<i4").tobytes(),
                    count[x].astype("<u2").tobytes(), rel[x].astype("<u2").tobytes(), body[T.ranges(base[x], length[x])].tobytes())]]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64())] + [pa.array(c, pa.binary()) for c in cols[1:]],
                                             ["bucket", "anchor", "rank", "uid", "lo", "count", "rel", "body"])

    return rows.join(asked, "uid").select("uid", "rank", "text", "spans").mapInArrow(run, CUTS)


def _sorted_windows(body, base, length, group, width: int):
    """Classes of equal windows, by suffix arrays of each group's strings.

    Returns (string, window in it, class) with equal classes for equal windows
    of one group.
    """
    new = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    total = np.add.reduceat(length + 1, new) + 1
    out = []
    order = np.argsort(total, kind="stable")     # texts of like length keep in step
    members = np.diff(np.r_[new, len(group)])
    for part in np.split(order, np.flatnonzero(np.diff(np.cumsum(total[order]) // BATCH)) + 1):
        if not len(part):
            continue
        who = T.ranges(new[part], members[part])
        size = length[who]
        off = np.r_[0, np.cumsum(total[part])]
        # each string is followed by 1, each text ends with 0, bytes are two higher
        text = np.repeat(np.arange(len(part)), members[part])
        at = off[text] + np.concatenate([[0], np.cumsum(size + 1)[:-1]]) - np.r_[0, np.cumsum(np.bincount(text, size + 1).astype(np.int64))][text]
        sym = np.zeros(off[-1], np.int64)
        where = T.ranges(at, size)
        raw = body[T.ranges(base[who], size)]
        sym[where] = raw + np.int64(2)
        sym[at + size] = 1
        sa = suffix_arrays(sym, off)
        start = np.full(off[-1], -1, np.int64)   # string of each window start
        wn = size - width + 1
        windows = T.ranges(at, wn)
        start[windows] = np.repeat(np.arange(len(who)), wn)
        sa = sa[start[sa] >= 0]
        flat = np.zeros(off[-1] + 8, np.uint8)
        flat[where] = raw
        eight = np.ndarray((off[-1],), "<u8", flat.tobytes(), strides=(1,))
        same = np.r_[False, np.repeat(np.arange(len(part)), total[part])[sa][1:] == np.repeat(np.arange(len(part)), total[part])[sa][:-1]]
        for j in [*range(0, width - 7, 8), width - 8]:
            x = eight[sa + j]
            same[1:] &= x[1:] == x[:-1]
        out.append((who[start[sa]], sa - at[start[sa]], np.cumsum(~same)))
    return out


class _Group:
    """The strings of one bucket, and their windows by how many bytes are left of the anchor.

    A window that has j bytes before its anchor has ``width - k - j`` after it.
    Those with j from ``low`` to ``high`` all hold the bytes from ``low`` before
    the anchor to ``width - k - high`` after it, so strings can share such a window
    only if they share that core. A string is cut to what its windows in the range cover.
    """

    def __init__(self, table, width: int, k: int):
        def joined(name, kind):
            return np.frombuffer(b"".join(x.as_buffer() for c in table.column(name).chunks for x in c), kind)
        self.anchor, self.rank, self.uid = joined("anchor", "<u8"), joined("rank", "<i8"), joined("uid", "<i8")
        self.lo, self.count, self.rel = (joined(n, t).astype(np.int64) for n, t in (("lo", "<i4"), ("count", "<u2"), ("rel", "<u2")))
        self.body = joined("body", np.uint8)
        length = self.count + width - 1
        self.pos = np.r_[0, np.cumsum(length)[:-1]] + self.rel  # of the anchor
        self.room, self.k = width - k, k
        self.pre = [S.prefix(T.BYTE_VALUE[i][self.body], i) for i in (0, 1)]

    def hashed(self, which: int, start, end):
        return S.rolled(self.pre[which], start, end)

    def sharing(self, who, low: int, high: int):
        """Strings of ``who`` with a window in the range and a core that another document's string has, by core.

        Returns (string, group, first and last j), groups in order.
        """
        first, last = np.maximum(self.rel[who] - self.count[who] + 1, low), np.minimum(self.rel[who], high)
        who, first, last = (x[first <= last] for x in (who, first, last))
        core = self.hashed(1, self.pos[who] - low, self.pos[who] + self.k + self.room - high) ^ T.mix(self.anchor[who])
        o = np.argsort(core, kind="stable")
        who, first, last, core = who[o], first[o], last[o], core[o]
        if not len(who):
            return who, who, first, last
        cut = np.flatnonzero(np.r_[True, core[1:] != core[:-1]])
        r, size = self.rank[who], np.diff(np.r_[cut, len(who)])
        many = np.repeat(np.minimum.reduceat(r, cut) < np.maximum.reduceat(r, cut), size)
        return who[many], np.repeat(np.arange(len(cut)), size)[many], first[many], last[many]


def _numbered(g: np.ndarray) -> np.ndarray:
    return np.cumsum(np.r_[True, g[1:] != g[:-1]][:len(g)]) - 1


def _repeats(t: _Group, width: int, largest: int):
    """(string, window) of the windows that a string of a smaller rank has too.

    Equal strings of a group are one. A group of different strings is sorted
    by its suffix array; one of more than ``largest`` symbols is first split
    by the two halves of its range of j, whose cores are longer, again and again:
    strings that share the core of a single j share that whole window, so they are all equal.
    """
    step = -(-t.room // 4)
    todo = [(np.arange(len(t.anchor)), low, min(low + step - 1, t.room)) for low in range(0, t.room + 1, step)]
    found, sorting, groups = [], [], 0
    while todo:
        who, low, high = todo.pop()
        who, g, first, last = t.sharing(who, low, high)
        if not len(who):
            continue
        start, end = t.pos[who] - last, t.pos[who] + t.k + t.room - first
        one, two = t.hashed(0, start, end), t.hashed(1, start, end) ^ T.mix((first * 64 + last).astype(np.uint64))
        o = np.lexsort((two, one, g))
        who, g, first, last, start, end, one, two = (x[o] for x in (who, g, first, last, start, end, one, two))
        g = _numbered(g)
        new = np.r_[True, (g[1:] != g[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])]
        lead = np.flatnonzero(new)
        text = np.cumsum(new) - 1
        least = np.minimum.reduceat(t.rank[who], lead)
        kinds = np.bincount(g[lead])
        symbols = np.bincount(g[lead], end[lead] - start[lead] + 1)
        alone = kinds[g] == 1
        late = alone & (t.rank[who] > least[text])
        found.append((np.repeat(who[late], (last - first + 1)[late]), T.ranges((t.rel[who] - last)[late], (last - first + 1)[late])))
        large = ~alone & (symbols[g] > largest) & (low < high)
        if large.any():
            half = (low + high) // 2
            todo += [(who[large], low, half), (who[large], half + 1, high)]
        rest = ~alone & ~large
        if rest.any():
            sub = rest[lead]
            place = np.cumsum(sub) - 1
            sorting.append((who[rest], (t.rel[who] - last)[rest], place[text[rest]], start[lead][sub], (end - start)[lead][sub], g[lead][sub] + groups, least[sub]))
            groups += int(g[-1]) + 1
    at = 0
    if sorting:
        shift = np.r_[0, np.cumsum([len(x[3]) for x in sorting])]
        who, offset, text, start, length, g, least = (np.concatenate(x) for x in zip(*[(*x[:2], x[2] + at, *x[3:]) for x, at in zip(sorting, shift)]))
        o = np.argsort(text, kind="stable")
        who, offset, members = who[o], offset[o], np.bincount(text, minlength=len(start))
        first = np.cumsum(members) - members
        for x, at, cls in _sorted_windows(t.body, start, length, g, width):
            low = np.full(int(cls.max()) + 1, S.LAST)
            np.minimum.at(low, cls, least[x])
            each = T.ranges(first[x], members[x])
            low, at = np.repeat(low[cls], members[x]), np.repeat(at, members[x])
            late = t.rank[who[each]] > low
            found.append((who[each][late], at[late] + offset[each][late]))
    return found


def _sort(cuts: DataFrame, width: int, k: int, largest: int = LARGEST) -> DataFrame:
    """Spans of the windows that a string of an earlier document has too."""
    def run(key, table):
        t = _Group(table, width, k)
        found = []
        for who, at in _repeats(t, width, largest):
            found += S.found_rows(t.uid[who], 0, t.lo[who] + at, np.ones(len(who), np.int64))
        schema = pa.schema([("uid", pa.int64()), ("kind", pa.int32()), ("spans", pa.binary())])
        T.release()
        return pa.Table.from_batches(found, schema) if found else schema.empty_table()

    return cuts.groupBy("bucket").applyInArrow(run, S.FOUND)


def suffix_dedup(docs: DataFrame, width: int = WIDTH, k: int = K, with_text: bool = True, extra: tuple = (),
                 largest: int = LARGEST) -> DataFrame:
    """Remove bytes of ``docs`` (doc_id, text) that repeat from an earlier document.

    Texts are UTF-8 bytes. Each byte covered by a ``width``-byte string that
    also starts in a document with a smaller doc_id goes; strings are judged on
    the input. Returns per row uid, doc_id, n_bytes, n_removed, n_spans (maximal
    removed runs), kept_sha256 and, if ``with_text``, text (the bytes left,
    without those of characters that were cut), and the ``extra`` columns of the
    input in a struct ``row``.

    Strings are brought together by their anchor k-mer (see :mod:`spans`), so
    that a suffix array is needed only of the strings around one anchor and not
    of the corpus. Strings that are equal throughout are settled as one; those
    that differ are grouped by the core around the anchor that their windows
    share, each group's strings become one text, its suffix array is
    built by Lyndon-prefix grouping (:mod:`lyndon`), and neighbours in it with
    ``width`` common bytes are equal windows. A group over ``largest`` symbols is
    split by longer cores until its parts fit, so the method is the same at every size.

    Null and empty texts, and texts shorter than ``width``, keep all they have;
    a repeat within one document removes nothing; rows that share a doc_id
    don't remove each other; null doc_ids come after all others. An empty table
    gives an empty result. Other columns are not read. A very long text is
    never cut: a task's memory follows its longest text.
    """
    rows = S.ranked(docs)
    size, _ = parts_for(rows, "text", 1)
    spark = docs.sparkSession
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // (8 << 20)))
    hot = S.common(rows, byte_units, k)
    found = stage(S.settle(S.scan(rows, byte_units, width, k, buckets, hot), True, buckets), "runs")
    finer = _sort(_cuts(rows, S.by_document(found, 1), width, k, buckets, hot), width, k, largest)
    spans = S.by_document(found.filter("kind = 0").unionByName(finer))
    names = ["uid", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["text"] * with_text + ["row"] * bool(extra)

    def cut(batches):
        for b in batches:
            for part in T.pieces(pa.Table.from_batches([b]), "text"):
                data, off = T.buffers(part.column("text"))
                out = [[] for _ in range(5)]
                for i, v in enumerate(x for c in part.column("spans").chunks for x in c):
                    own = data[off[i]:off[i + 1]]
                    gone = runs = 0
                    if v.is_valid:
                        sp = S.spans_of(v.values)
                        mask = T.covered(len(own), sp[:, 0], sp[:, 0] + sp[:, 1] + width - 1)
                        gone = int(mask.sum())
                        runs = int((mask[1:] & ~mask[:-1]).sum() + mask[:1].sum())
                        left = own[~mask].tobytes()
                    else:
                        left = own.tobytes()
                    for o, x in zip(out, (len(own), gone, runs, hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore") if with_text else None)):
                        o.append(x)
                ids = [pa.concat_arrays(part.column(c).chunks) for c in ("uid", "doc_id")]
                yield pa.RecordBatch.from_arrays(ids + [pa.array(o, pa.int64()) for o in out[:3]] + [pa.array(out[3], pa.string())]
                                                 + ([pa.array(out[4], pa.string())] if with_text else [])
                                                 + ([pa.concat_arrays(part.column("row").chunks)] if extra else []), names)

    full = S.ranked(docs, extra)
    joined = full.join(spans, "uid", "left").select("uid", "doc_id", "text", "spans", *["row"] * bool(extra))
    return joined.mapInArrow(cut, "uid long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", text string" * with_text
                               + (f", row {dict(full.dtypes)['row']}" if extra else ""))


def op1_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    from daystream.session import read_table
    return suffix_dedup(read_table(spark, sf_dir, "documents"), with_text=False).drop("uid")


OP1_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
-- blocks of 500 window starts: taking a piece of a long string costs its place in it
block AS (SELECT doc_id, b, substr(h, 1000 * b + 1, 1098) AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // 1000 + 1)) AS b FROM d)),
win AS (SELECT doc_id, 500 * b + j AS i, md5(substr(s, 2 * j + 1, 100)) AS w
        FROM (SELECT doc_id, b, s, unnest(range(0, least(500, length(s) // 2 - 49))) AS j FROM block)),
hit AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p
        FROM win JOIN (SELECT w, min(doc_id) AS f FROM win GROUP BY w) USING (w) WHERE f < doc_id),
run AS (SELECT doc_id, i, sum(CASE WHEN p IS NULL OR i > p + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM hit),
gone AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b, row_number() OVER (PARTITION BY doc_id ORDER BY min(i)) AS k FROM run GROUP BY doc_id, r),
edge AS (SELECT doc_id, k, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY k), 0) AS a, a AS b FROM gone
         UNION ALL SELECT doc_id, max(k) + 1, max(b), NULL FROM gone GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(CASE WHEN b IS NULL THEN substr(h, 2 * a + 1) ELSE substr(h, 2 * a + 1, 2 * (b - a)) END, '' ORDER BY k) AS t,
                max(k) - 1 AS n_spans FROM edge JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, ((length(h) - length(coalesce(t, h))) // 2)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(t, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
