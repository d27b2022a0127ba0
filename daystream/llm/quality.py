"""Quality rules and a hashed n-gram classifier."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystream.llm import linear
from daystream.llm import text as T

#: Hash cells of each feature family, and labelled rows to fit on at most.
CELLS, SAMPLE = 1 << 15, 2500
#: Units that a cell's share counts for at most, and what all are divided by.
CAP, SCALE = 10.0, 30.0
THRESHOLD = 0.5
MIN_WORDS = 50
#: Fixed value: the characters that count as symbols.
SYMBOLS = "#*$%&|<>"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS.encode())] = True
FAMILIES = 4


def measures(data, off):
    """Base measures of each text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; and its word spans."""
    n = len(off) - 1
    start, end, row = T.words(data, off)
    n_words = T.row_counts(row, n)
    solid = ~T.SPACE[data] & ((data & 0xC0) != 0x80)
    chars = np.r_[0, np.cumsum(solid)]
    symbols = np.r_[0, np.cumsum(_SYMBOL[data])]
    h = T.span_hash(data, start, end, 0) if len(start) else np.zeros(0, np.uint64)
    # three-word windows found twice or more in a text
    repeated = np.zeros(n, np.int64)
    if len(start) > 2:
        w = T.mix(T.mix(T.mix(h[:-2]) + h[1:-1]) + h[2:])
        ok = np.flatnonzero(row[:-2] == row[2:])
        w, r = w[ok], row[ok]
        o = np.lexsort((w, r))
        same = (w[o][1:] == w[o][:-1]) & (r[o][1:] == r[o][:-1])
        twice = np.zeros(len(o), bool)
        twice[1:] |= same
        twice[:-1] |= same
        at = ok[o[twice]]
        mark = np.zeros(len(start), bool)
        for j in range(3):
            mark[at + j] = True
        repeated = np.bincount(row[mark], minlength=n)
    # lines
    feed = np.flatnonzero(data == 10)
    has = np.flatnonzero(np.diff(off) > 0)
    line = np.unique(np.r_[off[has], feed + 1])
    line = line[line < len(data)] if len(line) else line
    stop = np.minimum(np.r_[line[1:], len(data)], len(data))
    stop = stop - ((stop > line) & (data[np.maximum(stop, 1) - 1] == 10)) if len(line) else stop
    dup = np.zeros(n, np.int64)
    if len(line):
        lr = np.searchsorted(off, line, side="right") - 1
        worded = np.searchsorted(start, stop) > np.searchsorted(start, line)
        line, stop, lr = line[worded], stop[worded], lr[worded]
        lh = T.span_hash(data, line, stop, 1)
        o = np.lexsort((lh, lr))
        same = (lh[o][1:] == lh[o][:-1]) & (lr[o][1:] == lr[o][:-1])
        dup = np.bincount(lr[o][1:][same], minlength=n)
    return (n_words, chars[off[1:]] - chars[off[:-1]], symbols[off[1:]] - symbols[off[:-1]], dup, repeated), (start, end, row, h)


def characters(data, off):
    """The UTF-8 bytes of each character as one number, and the texts' offsets in characters."""
    first = (data & 0xC0) != 0x80
    first[off[:-1][np.diff(off) > 0]] = True  # also where a text isn't valid UTF-8
    at = np.flatnonzero(first)
    c = data[at].astype(np.uint64)
    if len(at) < len(data):
        width = np.diff(np.r_[at, len(data)])
        for j in range(1, 4):
            more = np.flatnonzero(width > j)
            c[more] |= data[at[more] + j].astype(np.uint64) << np.uint64(8 * j)
    return c, np.searchsorted(at, off)


def ngrams(data, off, spans):
    """(row offsets, cell) of each family: words, word pairs, 3 and 5 characters (code points). None crosses two texts."""
    start, end, row, h = spans
    n = len(off) - 1
    mask = np.uint64(CELLS - 1)
    woff = np.r_[0, np.cumsum(T.row_counts(row, n))]
    yield woff, (h & mask).astype(np.int64)
    pair = T.mix(h[:-1] * np.uint64(3) + h[1:]) & mask if len(h) else h
    own = row[:-1] == row[1:] if len(h) else np.zeros(0, bool)
    yield np.r_[0, np.cumsum(T.row_counts(row[:-1][own], n))], pair[own].astype(np.int64)
    char, coff = characters(data, off)
    for size in (3, 5):
        if len(char) < size:
            yield np.zeros(n + 1, np.int64), np.zeros(0, np.int64)
            continue
        v = char[:len(char) - size + 1].copy()
        for j in range(1, size):
            v *= T.BASE[1]
            v += char[j:len(char) - size + 1 + j]
        cell = ((v * T.BASE[0]) >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)
        length = np.maximum(np.diff(coff) - size + 1, 0)
        at = T.ranges(coff[:-1], length) if (np.diff(coff) < size).any() or n > 1 else np.arange(len(cell))
        yield np.r_[0, np.cumsum(length)], cell[at]


def shares(families, n: int):
    """(row, cell, share of its family's n-grams) of the distinct cells of each text, by family: as the classifier is fitted and scored."""
    for f, (off, cell) in enumerate(families):
        size = np.diff(off)
        key, k = np.unique(np.repeat(np.arange(n), size) * CELLS + cell, return_counts=True)
        row = key // CELLS
        yield row, key % CELLS + f * CELLS, (k / size[row]).astype("<f4")


def values(share, unit):
    """What a cell counts: its share in units, capped."""
    return np.minimum(share / unit, CAP) / SCALE


def logits(model, families, n: int):
    """The calibrated log odds of each text."""
    w, unit, bias = model
    z = np.zeros(n)
    for row, cell, share in shares(families, n):
        z += np.bincount(row, values(share.astype(float), unit[cell]) * w[cell], n)
    return z + bias


def labelled(docs: DataFrame, labels: DataFrame, label: str, most: int, allowed=None) -> DataFrame:
    """(doc_id, text, target) of at most ``most`` labelled rows, chosen by a hash of doc_id."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("target")).filter(
        "doc_id is not null and target in (0, 1)")
    if allowed is not None:
        rows = rows.filter(allowed)
    # a doc_id that is labelled both ways says nothing
    rows = rows.groupBy("doc_id").agg(F.min("target").alias("target"), F.max("target").alias("hi")).filter("target = hi")
    rows = rows.select("doc_id", "target").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # at most ``most`` rows of 12 bytes
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(rows), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = SAMPLE):
    """(weights and units of families x cells, shift) fitted on a bounded sample, or None without labelled rows of both kinds.

    Three quarters of the sample fit the weights, the rest calibrates them to
    probabilities. What reaches the driver is the sample's sparse counts, one row
    for each doc_id: of a repeated one, the text whose counts come first.
    """
    def run(batches):
        for b in batches:
            for part in T.pieces(pa.Table.from_batches([b]), "text"):
                data, off = T.buffers(part.column("text"))
                _, spans = measures(data, off)
                cells, counts = [[] for _ in range(part.num_rows)], [[] for _ in range(part.num_rows)]
                for row, cell, share in shares(ngrams(data, off, spans), part.num_rows):
                    cut = np.searchsorted(row, np.arange(part.num_rows + 1))
                    for i in range(part.num_rows):
                        cells[i].append(cell[cut[i]:cut[i + 1]].astype("<i4"))
                        counts[i].append(share[cut[i]:cut[i + 1]])
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays(part.column("doc_id").chunks), pa.concat_arrays(part.column("target").chunks),
                     pa.array([np.concatenate(x).tobytes() for x in cells], pa.binary()), pa.array([np.concatenate(x).tobytes() for x in counts], pa.binary())],
                    ["doc_id", "target", "cells", "shares"])

    got = labelled(docs, labels, label, most).select("doc_id", "target", "text").mapInArrow(
        run, "doc_id long, target int, cells binary, shares binary").groupBy("doc_id", "target").agg(
        F.min(F.struct("cells", "shares")).alias("v")).select("doc_id", "target", "v.*").toArrow().sort_by("doc_id")
    target = got["target"].to_numpy().astype(float)
    if not len(target) or target.min() == target.max():
        return None
    def joined(name, kind):
        out = np.empty(sum(len(x.as_buffer()) for c in got[name].chunks for x in c) // 4, kind)
        at = 0
        for c in got[name].chunks:
            for x in c:
                v = np.frombuffer(x.as_buffer(), kind)
                out[at:at + len(v)] = v
                at += len(v)
        return out

    col, value = joined("cells", "<i4"), joined("shares", "<f4")
    row = np.repeat(np.arange(len(target), dtype=np.int32), [len(x.as_buffer()) // 4 for c in got["cells"].chunks for x in c])
    del got
    # each cell in units of its root mean square, rare ones held back
    unit = np.zeros(FAMILIES * CELLS)
    for s in linear.chunks(len(col)):
        unit += np.bincount(col[s], value[s].astype(float) ** 2, FAMILIES * CELLS)
    unit = np.sqrt(unit / len(target)) + 1e-4
    for s in linear.chunks(len(col)):
        value[s] = values(value[s], unit[col[s]])
    hold = np.arange(len(target)) % 4 == 3
    if not hold.any() or target[hold].min() == target[hold].max() or target[~hold].min() == target[~hold].max():
        hold[:] = False
    balance = np.where(target > 0.5, 0.5 / target.mean(), 0.5 / (1 - target.mean()))
    w, b = linear.logistic(row, col, value, len(target), FAMILIES * CELLS, target, np.where(hold, 0.0, balance), l2=1e-5)
    z = linear.logits(row, col, value, len(target), w) + b
    use = hold if hold.any() else ~hold
    scale, shift = linear.calibrate(z[use], target[use])
    return scale * w, unit, scale * b + shift


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, most: int = SAMPLE, keep_columns: tuple = ()) -> DataFrame:
    """Base rules and the classifier's verdict for every row of ``docs`` (doc_id, text).

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, score and kept, and ``keep_columns`` of the
    input. ``score`` is the calibrated probability of quality 1 from a logistic
    regression on hashed word and character n-gram shares (capped alike where
    it is fitted, calibrated and used), fitted on at most
    ``most`` labelled rows (chosen by hash, whole texts); all rows are scored in
    Arrow batches. ``kept`` is false if the base rules fail (fewer than 50
    words, or over half of the words in repeated three-word windows), else
    score >= ``threshold``.

    Without labelled rows of both kinds the score is null and the base rules
    decide. Null and empty texts have no words and fail. Labels that are null,
    neither 0 nor 1, or contradict one another are not used; labels of unknown
    documents are ignored. Repeated rows and null ids are scored as rows of
    their own; a labelled id that occurs often is one row of the sample. Texts of any
    length are scored whole, one at a time if they are long. An empty table gives an empty result.
    """
    model = fit(docs, labels, "quality", most)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]
    extra = [c for c in docs.columns if c in keep_columns and c not in names]

    def run(batches):
        for b in batches:
            for part in T.pieces(pa.Table.from_batches([b]), "__text"):
                data, off = T.buffers(part.column("__text"))
                m, spans = measures(data, off)
                failed = (m[0] < MIN_WORDS) | (100 * m[4] > 50 * m[0])
                if model is None:
                    score = pa.nulls(len(failed), pa.float64())
                    kept = ~failed
                else:
                    p = linear.sigmoid(logits(model, ngrams(data, off, spans), part.num_rows))
                    score, kept = pa.array(p), ~failed & (p >= threshold)
                cols = [pa.concat_arrays(part.column("__id").chunks), *(pa.array(x.astype(np.int64)) for x in m), pa.array(failed), score, pa.array(kept)]
                yield pa.RecordBatch.from_arrays(cols + [pa.concat_arrays(part.column(c).chunks) for c in extra], names + extra)

    kinds = dict(docs.dtypes)
    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean"
    return docs.select(F.col("doc_id").cast("long").alias("__id"), F.col("text").cast("string").alias("__text"), *extra).mapInArrow(
        run, schema + "".join(f", `{c}` {kinds[c]}" for c in extra))


def op9_quality(spark, sf_dir: str) -> DataFrame:
    from daystream.session import read_table
    return quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
