"""Language-model scores from Brown classes: exchange clustering and class bigrams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystream.llm import text as T
from daystream.llm.store import parts_for, stage
from daystream.llm.toxicity import LOWER

#: Word classes, words that exchange clustering places one by one, bytes of text in a block, weight of the backed-off part.
CLASSES, HEADS, BLOCK, BACKOFF = 32, 1000, 8 << 20, 5.0
#: Exchange sweeps over the words that aren't heads.
SWEEPS = 2
#: Codes of a token: 0 is the end, 1..CLASSES the classes, then unknown words.
END, UNKNOWN, ONCE = 0, CLASSES + 1, 128
END_HASH = np.uint64(0x1D8E4E27C47D124F)


def tokens(data, off):
    """(word hashes of all texts with an end after each, row offsets); A-Z is lower-cased."""
    n = len(off) - 1
    low = LOWER[data]
    start, end, row = T.words(low, off)
    k = T.row_counts(row, n)
    toff = np.r_[0, np.cumsum(k + 1)]
    out = np.full(int(toff[-1]), END_HASH, np.uint64)
    if len(start):
        out[np.arange(len(start)) + row] = T.span_hash(low, start, end, 0)
    return out, toff


def _squeeze(x: np.ndarray) -> bytes:
    """Non-negative 32-bit integers, small ones mostly: byte planes, compressed."""
    planes = np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.Codec("zstd").compress(planes.tobytes(), asbytes=True)


def _expand(blob: bytes, n: int) -> np.ndarray:
    raw = pa.Codec("zstd").decompress(blob, 4 * n, asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, n).T).view("<u4").ravel().astype(np.int64)


BLOCKS = "block long, n_tokens long, n_types long, doc_id binary, no_id binary, held binary, sizes binary, ids binary, hashes binary, counts binary"


def encode(docs: DataFrame, held, block: int = BLOCK) -> DataFrame:
    """Blocks of documents: their words numbered by how often the block has them, counts of the training part."""
    def run(batches):
        part, made, rows, size = TaskContext.get().partitionId(), 0, [], 0
        for b in batches:
            for piece in T.pieces(pa.Table.from_batches([b]), "text"):
                h, toff = tokens(*T.buffers(piece.column("text")))
                rows.append((piece.column("doc_id"), piece.column("held").to_numpy(zero_copy_only=False) if False else np.array(piece.column("held").to_pylist(), bool), h, np.diff(toff)))
                size += int(len(h)) * 6
                if size >= block:
                    yield flush(rows, part << 24 | made)
                    made, rows, size = made + 1, [], 0
        if rows:
            yield flush(rows, part << 24 | made)

    def flush(rows, name):
        ids = pa.chunked_array([c for r in rows for c in r[0].chunks])
        held, h, sizes = (np.concatenate([r[i] for r in rows]) for i in (1, 2, 3))
        types, inverse, n = np.unique(h, return_inverse=True, return_counts=True)
        order = np.argsort(-n, kind="stable")
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        train = np.repeat(~held, sizes)
        counts = np.bincount(inverse[train], minlength=len(types))[order]
        cells = (name, len(h), len(types), ids.fill_null(0).to_numpy().astype("<i8").tobytes(), ids.is_null().to_numpy().astype(np.uint8).tobytes(),
                 held.astype(np.uint8).tobytes(), sizes.astype("<i4").tobytes(), _squeeze(number[inverse]), types[order].astype("<u8").tobytes(), _squeeze(counts))
        return pa.RecordBatch.from_arrays([pa.array([c], pa.binary() if isinstance(c, bytes) else pa.int64()) for c in cells],
                                          [c.split()[0] for c in BLOCKS.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.coalesce(held, F.lit(False)).alias("held")).mapInArrow(run, BLOCKS)


def _blocks(batch):
    for i in range(batch.num_rows):
        get = lambda c: batch.column(c)[i].as_py()
        n, k = get("n_tokens"), get("n_types")
        yield (get("block"), _expand(get("ids"), n), np.frombuffer(get("hashes"), "<u8"), _expand(get("counts"), k),
               np.frombuffer(get("held"), np.uint8).astype(bool), np.frombuffer(get("sizes"), "<i4").astype(np.int64), get)


def _dealt(hashes, buckets: int):
    """(bucket, indices of its words) of every bucket that has words of a block."""
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    o = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.r_[True, bucket[o][1:] != bucket[o][:-1]]) if len(o) else np.zeros(0, np.int64)
    return [(int(bucket[o[s]]), o[s:e]) for s, e in zip(cut, np.r_[cut[1:], len(o)])]


def _joined(t, name, kind):
    return np.frombuffer(b"".join(x.as_buffer() for c in t.column(name).chunks for x in c), kind)


def heads(blocks: DataFrame, buckets: int, most: int = HEADS) -> np.ndarray:
    """Hashes of the most frequent training words, by rank.

    Every training word of every block is counted: blocks send all their
    counts, packed by bucket of the word, and each bucket gives its ``most``
    most frequent words.
    """
    def run(batches):
        for b in batches:
            for _, _, hashes, counts, *_ in _blocks(b):
                some = np.flatnonzero((hashes != END_HASH) & (counts > 0))
                dealt = [(bucket, some[x]) for bucket, x in _dealt(hashes[some], buckets)]
                yield packed([(bucket, hashes[x], counts[x]) for bucket, x in dealt])

    def packed(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1].tobytes() for r in rows], pa.binary()),
                                           pa.array([r[2].astype("<i8").tobytes() for r in rows], pa.binary())], ["bucket", "hashes", "counts"])

    def top(hashes, counts):
        types, inverse = np.unique(hashes, return_inverse=True)
        n = np.bincount(inverse, counts).astype(np.int64)
        o = np.lexsort((types.view(np.int64), -n))[:most]
        return types[o], n[o]

    def merged(key, t):
        return pa.Table.from_batches([packed([(key[0].as_py(), *top(_joined(t, "hashes", "<u8"), _joined(t, "counts", "<i8")))])])

    kind = "bucket long, hashes binary, counts binary"
    best = blocks.mapInArrow(run, kind).groupBy("bucket").applyInArrow(merged, kind)
    best = best.withColumn("bucket", F.col("bucket") % 16).groupBy("bucket").applyInArrow(merged, kind)
    rows = best.collect()  # at most 16 rows of ``most`` words
    return top(np.concatenate([np.zeros(0, "<u8"), *(np.frombuffer(r["hashes"], "<u8") for r in rows)]),
               np.concatenate([np.zeros(0, "<i8"), *(np.frombuffer(r["counts"], "<i8") for r in rows)]))[0]


def head_pairs(blocks: DataFrame, known: np.ndarray) -> np.ndarray:
    """How often head i is followed by head j in training texts; the last two rows and columns are the end and all other words."""
    k = len(known) + 2
    order = np.argsort(known)

    def run(batches):
        total = np.zeros((k, k), np.int64)
        for b in batches:
            for _, ids, hashes, _, held, sizes, _ in _blocks(b):
                code = _number(hashes, known, order)[ids]
                train = np.repeat(~held, sizes)
                left = np.r_[k - 2, code[:-1]]
                # a text's first word follows an end, as the token before it is one
                total += np.bincount(left[train] * k + code[train], minlength=k * k).reshape(k, k)
        some = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([total[i].astype("<i8").tobytes() for i in some], pa.binary())], ["i", "n"])

    def add(key, t):
        rows = np.stack([np.frombuffer(x.as_buffer(), "<i8") for c in t.column("n").chunks for x in c])
        return pa.table({"i": pa.array([key[0].as_py()], pa.int64()), "n": pa.array([rows.sum(0).astype("<i8").tobytes()], pa.binary())})

    out = np.zeros((k, k), np.int64)
    for r in blocks.mapInArrow(run, "i long, n binary").groupBy("i").applyInArrow(add, "i long, n binary").collect():  # k x k at most
        out[r["i"]] = np.frombuffer(r["n"], "<i8")
    return out


def _number(hashes, known, order):
    """Index in ``known``, or len(known) for the end and one more for other words."""
    if not len(known):
        return np.where(hashes == END_HASH, 0, 1)
    at = np.searchsorted(known, hashes, sorter=order)
    at[at == len(known)] = 0
    at = order[at]
    return np.where(known[at] == hashes, at, np.where(hashes == END_HASH, len(known), len(known) + 1))


def _xlogx(x):
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = 12) -> np.ndarray:
    """Class 1..classes of each head by exchange clustering on the pair counts.

    Words start in classes by rank; then each in turn is taken out and put
    where the class bigram likelihood becomes largest, until a sweep moves
    none. The end and the other words keep classes of their own (0, classes+1).
    """
    heads_, k = len(pairs) - 2, classes + 2
    cls = np.r_[1 + np.arange(heads_) % classes, END, classes + 1].astype(np.int64)
    b = pairs.astype(float)
    hot = np.eye(k)[cls]
    m = hot.T @ b @ hot
    for _ in range(sweeps):
        moved = 0
        for w in range(heads_):
            out, into, own = np.bincount(cls, b[w], k), np.bincount(cls, b[:, w], k), b[w, w]
            c = cls[w]
            m[c] -= out
            m[:, c] -= into
            m[c, c] += own
            out[c] -= own       # own pairs are added by themselves
            into[c] -= own
            left, right = m.sum(1), m.sum(0)
            fm = _xlogx(m)
            row, col = _xlogx(m + out) - fm, _xlogx(m + into[:, None]) - fm
            d = np.arange(k)
            gain = row.sum(1) - row[d, d] + col.sum(0) - col[d, d] + _xlogx(m[d, d] + out + into + own) - fm[d, d]
            gain -= _xlogx(left + out.sum() + own) - _xlogx(left) + _xlogx(right + into.sum() + own) - _xlogx(right)
            new = 1 + int(np.argmax(gain[1:classes + 1]))
            if gain[new] <= gain[c] + 1e-9:
                new = c
            moved += new != c
            cls[w] = new
            m[new] += out
            m[:, new] += into
            m[new, new] += own
        if not moved:
            break
    return cls[:heads_]


PLACED = "bucket long, block long, hashes binary, numbers binary, counts binary, now binary, entries long, keys binary, sums binary"


def _contexts(block, ids, hashes, counts, held, sizes, cls, fixed, buckets, classes):
    """A block's words with their counts, classes and class contexts, packed by bucket of the word; first (bucket -1) its class pairs.

    A context is a class before (its number), a class after (classes + 2
    more) or, last, the word before itself. The words of heads and the end
    (``fixed``) stay where they are and need none.
    """
    k = classes + 2
    width = 2 * k + 1
    train = np.repeat(~held, sizes)
    c = cls[ids]
    before, after = np.r_[END, c[:-1]], np.r_[c[1:], END]
    m = np.bincount(before[train] * k + c[train], minlength=k * k)
    use = np.flatnonzero(train & ~fixed[ids])
    same = np.r_[False, ids[1:] == ids[:-1]]
    own, next_own = same[use], np.r_[same[1:], False][use]
    found, sums = np.unique(np.r_[ids[use] * width + np.where(own, 2 * k, before[use]), (ids[use] * width + k + after[use])[~next_own]], return_counts=True)
    first = np.searchsorted(found, np.arange(len(hashes) + 1) * width)
    cells = [[-1], [block], [m.astype("<i8").tobytes()], [b""], [b""], [b""], [0], [b""], [b""]]
    for bucket, x in _dealt(hashes, buckets):
        size = np.diff(first)[x]
        at = T.ranges(first[x], size)
        keys = np.repeat(np.arange(len(x)), size) * width + found[at] % width
        for cell, v in zip(cells, (bucket, block, hashes[x].tobytes(), _squeeze(x), _squeeze(counts[x]),
                                   (cls[x] + np.where(fixed[x], ONCE, 0)).astype(np.uint8).tobytes(), len(keys), _squeeze(keys), _squeeze(sums[at]))):
            cell.append(v)
    names = PLACED.split(", ")
    return pa.RecordBatch.from_arrays([pa.array(v, pa.int64() if n.endswith("long") else pa.binary()) for v, n in zip(cells, names)], [n.split()[0] for n in names])


def place(blocks: DataFrame, known: np.ndarray, cls: np.ndarray, buckets: int, classes: int = CLASSES) -> DataFrame:
    """The contexts of every block's words where only the heads have classes."""
    order = np.argsort(known)
    of = np.r_[cls, END, classes + 1]

    def run(batches):
        for b in batches:
            for block, ids, hashes, counts, held, sizes, _ in _blocks(b):
                code = of[_number(hashes, known, order)]
                yield _contexts(block, ids, hashes, counts, held, sizes, code, code <= classes, buckets, classes)

    return blocks.mapInArrow(run, PLACED)


def _replied(n_types, right):
    """(training counts, classes, fixed words) of a block from the replies of the buckets."""
    n, cls = np.zeros(n_types, np.int64), np.zeros(n_types, np.int64)
    for i in range(right.num_rows):
        of = np.frombuffer(right.column("classes")[i].as_buffer(), np.uint8)
        at = _expand(right.column("numbers")[i].as_py(), len(of))
        n[at] = _expand(right.column("counts")[i].as_py(), 2 * len(of)).astype("<u4").view("<i8")
        cls[at] = of
    return n, cls & (ONCE - 1), cls >= ONCE


def replace(blocks: DataFrame, replies: DataFrame, buckets: int, classes: int = CLASSES) -> DataFrame:
    """The contexts of every block's words where all training words have the classes of ``replies``."""
    def run(left, right):
        out = []
        for block, ids, hashes, counts, held, sizes, get in _blocks(left.combine_chunks().to_batches()[0]):
            _, cls, fixed = _replied(get("n_types"), right)
            out.append(_contexts(block, ids, hashes, counts, held, sizes, cls, fixed, buckets, classes))
        return pa.Table.from_batches(out)

    return blocks.groupBy("block").cogroup(replies.filter("block >= 0").groupBy("block")).applyInArrow(run, PLACED)


def class_pairs(placed: DataFrame, classes: int = CLASSES) -> np.ndarray:
    """How often class i is followed by class j in training texts."""
    def run(batches):
        total = np.zeros((classes + 2) ** 2, np.int64)
        for b in batches:
            for x in b.column(0):
                total += np.frombuffer(x.as_buffer(), "<i8")
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["pair", "n"])

    out = np.zeros((classes + 2) ** 2)
    for r in placed.filter("bucket < 0").select("hashes").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():  # k x k at most
        out[r["pair"]] = r["n"]
    return out.reshape(classes + 2, classes + 2)


def best_class(m: np.ndarray, keys: np.ndarray, sums: np.ndarray, now: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """The class each word is exchanged into, by its contexts (``keys``, sorted: word * width + context) against class pairs ``m``.

    What it gains the class bigram likelihood is reckoned as in ``exchange``,
    with all words taken out and put back at a time: the others count in the
    classes they are in. The smallest of the best classes; a word stays where
    it gains nothing by leaving.
    """
    k = classes + 2
    width = 2 * k + 1
    word, ctx = keys // width, keys % width
    left, right, own = ctx < k, (ctx >= k) & (ctx < 2 * k), ctx == 2 * k
    size = len(now)
    n_left = np.bincount(word, np.where(right, 0, sums), size)
    n_right = np.bincount(word, np.where(left, 0, sums), size)
    rows, cols = m.sum(1), m.sum(0)
    side = np.where(left, ctx, ctx - k)
    best, out = np.full(size, -np.inf), np.ones(size, np.int64)
    stay = np.full(size, -np.inf)
    for c in range(1, classes + 1):
        cell = np.where(own, m[c, c], np.where(left, m[np.where(left, side, 0), c], m[c, np.where(right, side, 0)]))
        here = now == c
        cell = np.maximum(cell - np.where(here[word], sums, 0), 0.0)
        gain = np.bincount(word, _xlogx(cell + sums) - _xlogx(cell), size).astype(float)
        for total, n in ((rows[c], n_right), (cols[c], n_left)):
            base = np.maximum(total - np.where(here, n, 0), 0.0)
            gain -= _xlogx(base + n) - _xlogx(base)
        stay[here] = gain[here]
        better = gain > best
        best[better], out[better] = gain[better], c
    keep = best <= stay + 1e-9
    out[keep] = now[keep]
    return out


def settle(placed: DataFrame, m: np.ndarray, classes: int = CLASSES) -> DataFrame:
    """By bucket: each word's training count and class, sent back to the blocks; and (block -1) the bucket's known words.

    A word's class contexts are summed over all blocks before it is placed.
    The class of a head or the end is sent with ``ONCE`` added.
    """
    def run(key, t):
        hashes, numbers = _joined(t, "hashes", "<u8"), t.column("numbers").to_pylist()
        sizes = [len(x.as_buffer()) // 8 for c in t.column("hashes").chunks for x in c]
        cut = np.r_[0, np.cumsum(sizes)]
        counts = np.concatenate([_expand(x, k) for x, k in zip(t.column("counts").to_pylist(), sizes)])
        types, first, word = np.unique(hashes, return_index=True, return_inverse=True)
        n = np.bincount(word, counts, len(types)).astype(np.int64)
        now = _joined(t, "now", np.uint8).astype(np.int64)[first]
        width = 2 * (classes + 2) + 1
        keys, sums = [], []
        for i, entries in enumerate(t.column("entries").to_pylist()):
            key_, sum_ = (_expand(t.column(c)[i].as_py(), entries) for c in ("keys", "sums"))
            keys.append(word[cut[i] + key_ // width] * width + key_ % width)
            sums.append(sum_)
        keys, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.bincount(inverse, np.concatenate(sums), len(keys))
        cls = np.where(now >= ONCE, now, best_class(m, keys, sums, now, classes))
        blocks = t.column("block").to_pylist()
        rows = [[], [], [], []]
        for i, block in enumerate(blocks):
            s = slice(cut[i], cut[i + 1])
            for r, v in zip(rows, (block, numbers[i], _squeeze(n[word[s]].astype("<i8").view("<u4")), cls[word[s]].astype(np.uint8).tobytes())):
                r.append(v)
        for r, v in zip(rows, (-1, b"", np.array([n.sum(), (n > 0).sum()], "<i8").tobytes(), b"")):
            r.append(v)
        return pa.table([pa.array(rows[0], pa.int64()), *(pa.array(r, pa.binary()) for r in rows[1:])], ["block", "numbers", "counts", "classes"])

    return placed.filter("bucket >= 0").groupBy("bucket").applyInArrow(run, "block long, numbers binary, counts binary, classes binary")


CODED = "doc_id long, held boolean, n_tokens long, n_known long, base_score double, known_log double, codes binary"


def code(blocks: DataFrame, replies: DataFrame, total: int, types: int) -> DataFrame:
    """Each document's class codes, and what of its scores doesn't need the class statistics."""
    names = [x.split()[0] for x in CODED.split(", ")]

    def run(left, right):
        out = []
        k = left.column("n_types")[0].as_py()
        n, cls, _ = _replied(k, right)
        cls = np.where(n > 0, cls, UNKNOWN) + np.where(n == 1, ONCE, 0)
        base = np.log10((n + 1) / (total + types + 1))
        log = np.where(n > 0, np.log10(np.maximum(n, 1)), 0.0)
        for _, ids, _, _, held, sizes, get in _blocks(left.combine_chunks().to_batches()[0]):
            off = np.r_[0, np.cumsum(sizes)]
            sums = [np.add.reduceat(x[ids], off[:-1]) for x in ((n > 0).astype(np.int64), base, log)]
            codes = cls.astype(np.uint8)[ids]
            doc = pa.array(np.frombuffer(get("doc_id"), "<i8"), mask=np.frombuffer(get("no_id"), np.uint8).astype(bool))
            blob = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(off.astype(np.int64).tobytes()), pa.py_buffer(codes.tobytes())])
            out.append(pa.RecordBatch.from_arrays([doc, pa.array(held), pa.array(sizes), *(pa.array(x) for x in sums), blob.cast(pa.binary())], names))
        return pa.Table.from_batches(out)

    return blocks.groupBy("block").cogroup(replies.filter("block >= 0").groupBy("block")).applyInArrow(run, CODED)


def transitions(coded: DataFrame):
    """(pair counts of codes, pair counts into words met once) over the training texts."""
    k = UNKNOWN + 1

    def run(batches):
        total = np.zeros((2, k * k), np.int64)
        for b in batches:
            for held, codes in zip(b.column(0), b.column(1)):
                if held.as_py():
                    continue
                c = np.frombuffer(codes.as_buffer(), np.uint8).astype(np.int64)
                once, c = c >= ONCE, c & (ONCE - 1)
                pair = np.r_[END, c[:-1]] * k + c
                total[0] += np.bincount(pair, minlength=k * k)
                total[1] += np.bincount(pair[once], minlength=k * k)
                after = np.flatnonzero(once)
                # what follows a word met once stands for what follows an unknown word
                after = after[after + 1 < len(c)]
                total[0] += np.bincount(UNKNOWN * k + c[after + 1], minlength=k * k)
                total[1] += np.bincount(UNKNOWN * k + c[after + 1][once[after + 1]], minlength=k * k)
        for kind in (0, 1):
            some = np.flatnonzero(total[kind])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), kind, np.int64)), pa.array(some), pa.array(total[kind][some])], ["kind", "pair", "n"])

    out = np.zeros((2, k * k))
    for r in coded.select("held", "codes").mapInArrow(run, "kind long, pair long, n long").groupBy("kind", "pair").agg(F.sum("n").alias("n")).collect():  # 2 k^2 rows
        out[r["kind"], r["pair"]] = r["n"]
    return out.reshape(2, k, k)


def model(pairs: np.ndarray, backoff: float = BACKOFF):
    """(log10 of code given the code before, log10 of each class's tokens).

    P(unknown | before) is the share of words met once among what follows, and
    known classes share the rest by their counts; both are mixed with what
    follows any code, as if ``backoff`` tokens of it had been seen.
    """
    all_, once = pairs
    seen = all_[:UNKNOWN, :]      # rows of real training tokens
    total, size = seen.sum(), seen.sum(0)
    if total == 0:
        return np.where(np.arange(UNKNOWN + 1) == UNKNOWN, 0.0, -300.0)[None, :].repeat(UNKNOWN + 1, 0), np.zeros(UNKNOWN + 1)
    share = min(0.75, (once[:UNKNOWN].sum() + 0.5) / (total + 1))
    p_unknown = np.minimum(0.75, (once.sum(1) + backoff * share) / (all_.sum(1) + backoff))
    p = (all_ + backoff * size / total) / (all_.sum(1, keepdims=True) + backoff)
    p = p * (1 - p_unknown)[:, None]
    p[:, UNKNOWN] = p_unknown
    return np.log10(np.maximum(p, 1e-300)), np.log10(np.maximum(size, 1.0))


def class_scores(docs: DataFrame, held, classes: int = CLASSES, most: int = HEADS, block: int = BLOCK, sweeps: int = SWEEPS) -> DataFrame:
    """Unigram and Brown class bigram scores of every row of ``docs`` (doc_id, text).

    ``held`` (a column) marks the rows the model must not learn from. Returns
    doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Words are compared by a 64-bit hash of their lower-cased bytes. The
    ``most`` most frequent words, by exact counts, are placed by exchange
    clustering on their pair counts over all training texts; every other
    training word is exchanged in ``sweeps`` sweeps by its class contexts
    summed over all training texts, in the first one by those of the most
    frequent words, then by those of all. Scores don't depend on the size of
    blocks (``block`` bytes of text, about) or the partitioning.
    score is the sum over tokens of log10 P(class | class before) P(word |
    class), with P(word | class) its share of the class's training tokens and
    P(unknown | class before) from words met once; base_score is the smoothed
    unigram. All counts are over all training texts. A text begins after an
    end.

    What is collected on the driver is bounded by ``most`` and ``classes``.
    Null and empty texts are one end. Without training rows every token is
    unknown and both scores are 0. Null ids are scored; repeated rows count
    as often as they occur. An empty table gives an empty result. Other columns
    are not read.
    """
    spark = docs.sparkSession
    size, _ = parts_for(docs, "text", 1)
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // (16 << 20)))
    blocks = stage(encode(docs, held, block), "blocks")
    known = heads(blocks, buckets, most)
    pairs = head_pairs(blocks, known)
    cls = exchange(pairs, classes)
    hot = np.eye(classes + 2)[np.r_[cls, END, classes + 1]]
    replies = stage(settle(place(blocks, known, cls, buckets, classes), hot.T @ pairs @ hot, classes), "words")
    for _ in range(1, sweeps):
        placed = stage(replace(blocks, replies, buckets, classes), "contexts")
        replies = stage(settle(placed, class_pairs(placed, classes), classes), "words")
    sums = replies.filter("block < 0").select("counts").mapInArrow(_sums, "n long, types long").agg(F.sum("n").alias("n"), F.sum("types").alias("types")).first()
    total, types = int(sums["n"] or 0), int(sums["types"] or 0)
    coded = stage(code(blocks, replies, total, types), "codes")
    log_p, log_size = model(transitions(coded))
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches):
        for b in batches:
            codes = b.column("codes").cast(pa.large_binary())
            data, off = T.buffers(codes)
            c = (data & (ONCE - 1)).astype(np.int64)
            before = np.r_[END, c[:-1]]
            # the token before a text's first is an end, that of the text before
            step = log_p[before, c] - np.where(c < UNKNOWN, log_size[c], 0.0)
            s = np.add.reduceat(step, off[:-1]) if len(c) else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held"), b.column("n_tokens"), b.column("n_known"), pa.array(np.full(b.num_rows, total, np.int64)),
                 b.column("base_score"), pa.array(s + b.column("known_log").to_numpy())], names)

    return coded.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _sums(batches):
    for b in batches:
        x = np.array([np.frombuffer(v.as_buffer(), "<i8") for v in b.column(0)]).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1])], ["n", "types"])


def op2_class_lm(spark, sf_dir: str) -> DataFrame:
    from daystream.session import read_table
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return class_scores(read_table(spark, sf_dir, "documents"), held)
