"""Which tokens of one tokenizer cover the bytes of which tokens of another.

A is a byte-level BPE of ``tokenizers``, B a ``sentencepiece`` model; both see
one space and the text.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable
from itertools import chain, compress, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daystream.llm import text as T
from daystream.llm.store import stage

#: Bytes of text that share one dictionary of id pairs.
BLOCK = 4 << 20
#: Characters that are encoded in one call.
CALL = 1 << 13
#: Links of a group that are written out one by one; larger groups go by distinct ids.
WIDE = 4096
#: Stretches whose tokens a worker remembers after a block (about 250 bytes each), and tokens of one of them at most.
KNOWN, SHORT = 250_000, 64
#: A place where neither tokenizer joins what is on either side.
SEAM = re.compile(r"(?<=\S)(?=[ \n])")


def split_at_seams(text: str) -> list[str]:
    """``text`` cut at its seams; without a regular expression where each word has one blank or line feed before it."""
    words = text.split()
    if len(text) == sum(map(len, words)) + len(words) and text.count(" ") + text.count("\n") == len(words) and "\0" not in text:
        return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")[1:]
    return SEAM.split(text)


class _Numbers(dict):
    """Numbers keys in the order they are asked for."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]][:len(x)]]


class Tokens(NamedTuple):
    """Ids of A and B and the byte where each ends."""
    a: np.ndarray
    a_end: np.ndarray
    b: np.ndarray
    b_end: np.ndarray


class Known:
    """Tokens of the stretches that an aligner has met, numbered as they came.

    Frequent words come back in every block, so their tokens are kept from one
    to the next. :meth:`forget` bounds that: beyond ``most``, only those that
    came in two blocks or more since the last time stay.
    """

    def __init__(self, most: int = KNOWN):
        self.most = most
        self.place = _Numbers()
        self.size, self.seen, self.good = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, bool)
        # of A and B: first token and number of tokens of each stretch; ids and ends of all tokens, ends from the stretch's start
        self.first, self.count = ([np.zeros(0, np.int32) for _ in "ab"] for _ in range(2))
        self.ids, self.ends = ([np.zeros(0, np.int32) for _ in "ab"] for _ in range(2))

    def add(self, found: list[tuple[int, Tokens]], good: np.ndarray, size: np.ndarray, order: np.ndarray) -> None:
        """The next stretches, with their bytes; :meth:`Aligner._many` had them in ``order``."""
        end = np.cumsum(np.where(good, size, 0)[order])
        start = np.r_[0, end]
        for i in (0, 1):
            ids, ends = (np.concatenate([t[2 * i + k] + (start[at] if k else 0) for at, t in found] or [np.zeros(0, np.int64)]) for k in (0, 1))
            of = np.searchsorted(end, ends)
            count = np.bincount(of, minlength=len(order))
            first, n = np.empty((2, len(order)), np.int32)
            first[order], n[order] = np.cumsum(count) - count + len(self.ids[i]), count
            self.first[i], self.count[i] = np.r_[self.first[i], first], np.r_[self.count[i], n]
            self.ids[i] = np.r_[self.ids[i], ids.astype(np.int32)]
            self.ends[i] = np.r_[self.ends[i], (ends - start[of]).astype(np.int32)]
        self.size, self.good = np.r_[self.size, np.where(good, size, 0)], np.r_[self.good, good]
        self.seen = np.r_[self.seen, np.zeros(len(order), np.int32)]

    def tokens(self, own: np.ndarray) -> tuple[Tokens, np.ndarray]:
        """Tokens of the stretches ``own``, one after another, and the byte where each stretch ends."""
        end, out = np.cumsum(self.size[own]), []
        for i in (0, 1):
            n = self.count[i][own].astype(np.int64)
            at = T.ranges(self.first[i][own], n)
            out += [self.ids[i][at].astype(np.int64), self.ends[i][at] + np.repeat(end - self.size[own], n)]
        return Tokens(*out), end

    def forget(self) -> None:
        keep = self.good & (self.count[0] + self.count[1] <= SHORT)
        if len(keep) > self.most:
            keep &= self.seen > 1
            self.seen[:] = 1
            if keep.sum() > self.most:
                keep[:] = False
        if keep.all():
            return
        place = _Numbers()
        place.update(zip(compress(self.place, keep.tolist()), range(int(keep.sum()))))
        self.place = place
        for i in (0, 1):
            n = self.count[i][keep]
            at = T.ranges(self.first[i][keep], n)
            self.ids[i], self.ends[i] = self.ids[i][at], self.ends[i][at]
            self.first[i], self.count[i] = (np.cumsum(n) - n).astype(np.int32), n
        self.size, self.seen, self.good = self.size[keep], self.seen[keep], self.good[keep]


class Aligned(NamedTuple):
    """Documents as stretches of text (``stretch`` up to ``stretch_end`` of each
    document), and of each stretch its tokens, groups, links, the groups written
    out and its distinct id pairs (``pair`` up to ``pair_end``, places in
    ``id_pair``) with their links."""
    stretch: np.ndarray
    stretch_end: np.ndarray
    figures: list[np.ndarray]
    groups: list[str]
    pair: np.ndarray
    pair_end: np.ndarray
    times: np.ndarray
    id_pair: np.ndarray


def byte_ends(ids: np.ndarray, start: np.ndarray, stop: np.ndarray, at: np.ndarray | None, size: np.ndarray) -> np.ndarray:
    """Byte offset where each token ends.

    The end of a token's span is a sure cut if the span isn't empty and no later
    one starts before it; ``at`` gives the byte of a character. Tokens that
    share a character (parts of a multibyte one, bytes written as tokens of
    their own) are told apart by the bytes they decode to.
    """
    sure = (start < stop) & np.r_[start[1:] >= stop[:-1], True][:len(ids)]
    cut = stop if at is None else at[stop]
    return cut if sure.all() else np.where(sure, cut, np.cumsum(size[ids]))


class Bytes:
    """The bytes of a vocabulary's entries."""

    def __init__(self, entries: list[bytes]):
        self.size = np.array([len(x) for x in entries], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.every = np.frombuffer(b"".join(entries), np.uint8)

    def of(self, ids: np.ndarray) -> bytes:
        return self.every[T.ranges(self.start[ids], self.size[ids])].tobytes()


class Aligner:
    """Aligns texts under two tokenizer files."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer, processors
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.post_processor = processors.ByteLevel(trim_offsets=False)
        self.b = SentencePieceProcessor(model_file=b_path)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # the bytes that byte-level vocabularies write as themselves
        other = [b for b in range(256) if b not in set(shown)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(other)}
        vocabulary = self.a.get_vocab()
        a = [b""] * (max(vocabulary.values()) + 1)
        for w, i in vocabulary.items():
            a[i] = bytes(byte[c] for c in w) if all(c in byte for c in w) else w.encode()
        piece = self.b.id_to_piece
        self.a_bytes, self.b_bytes = Bytes(a), Bytes([bytes([int(piece(i)[3:5], 16)]) if self.b.is_byte(i) else piece(i).replace("▁", " ").encode()
                                                      for i in range(self.b.get_piece_size())])
        # how ids are written: of A inside and at the end of their part of a group, then of B
        self.shown = np.array([f"{i}{end}" for t, ends in ((self.a_bytes, ",|"), (self.b_bytes, ",;")) for end in ends for i in range(len(t.size))], object)
        self.seams = self._seams(a_path, b_path)
        self.known = Known()

    def _seams(self, a_path: str, b_path: str) -> bool:
        """Whether a text may be cut where a blank or line feed follows a visible character.

        A's standard split never joins across that place, and neither does a BPE
        model B without a normalizer if no piece has a blank after another
        character or a line feed in it. Else every text is encoded whole.
        """
        import json

        from sentencepiece import sentencepiece_model_pb2 as model
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, m = spec.get("pre_tokenizer") or {}, model.ModelProto()
        with open(b_path, "rb") as f:
            m.ParseFromString(f.read())
        norm, kinds = m.normalizer_spec, model.ModelProto.SentencePiece
        return (spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
                and m.trainer_spec.model_type == model.TrainerSpec.BPE and norm.name == "identity" and not norm.precompiled_charsmap
                and norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces
                and not any("▁" in p.piece.lstrip("▁") or "\n" in p.piece for p in m.pieces if p.type != kinds.BYTE))

    def tokens(self, text: str) -> Tokens | None:
        """Tokens of one text; None where their bytes differ from it.

        A text starts with a blank (B is given the rest, and adds one) or, taken
        from another text, with a line feed (B's own blank is then taken off).
        """
        raw, blank = text.encode(), text[0] == " "
        x = self.a.encode(text, add_special_tokens=False)
        y = self.b.encode(text[1:] if blank else text, return_type="offset_mapping")
        a, b = np.array(x.ids, np.int64), np.array(y["ids"], np.int64)
        a_span, b_span = (np.fromiter(chain.from_iterable(v), np.int64, 2 * len(v)).reshape(-1, 2) for v in (x.offsets, y["offsets"]))
        if blank:
            b_span[:, 1] += 1  # the blank that B adds is text here
            b_span[1:, 0] += 1
        elif len(b) and self.b_bytes.of(b[:1]) == b" ":
            b, b_span = b[1:], b_span[1:]
        if self.a_bytes.of(a) != raw or self.b_bytes.of(b) != raw:
            return None
        at = None
        if len(raw) != len(text):
            at = np.r_[np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80), len(raw)]
        return Tokens(a, byte_ends(a, *a_span.T, at, self.a_bytes.size), b, byte_ends(b, *b_span.T, at, self.b_bytes.size))

    def _many(self, texts: list[str], plain: int) -> tuple[list[tuple[int, Tokens]], np.ndarray]:
        """Tokens of stretches as (first stretch, tokens of one or more), and which stretches have their own bytes.

        The first ``plain`` end in a visible character, so one after another
        they have seams between them and many are encoded in one call.
        """
        size = np.cumsum([len(t) for t in texts[:plain]], dtype=np.int64)
        at = [0, *(np.flatnonzero(np.diff(size // CALL)) + 1).tolist()] if plain else []
        calls = list(zip(at, [*at[1:], plain])) + [(k, k + 1) for k in range(plain, len(texts))]
        out, good = [], np.ones(len(texts), bool)
        for i, j in calls:
            got = self.tokens("".join(texts[i:j]))
            found = [(i, got)] if got or j - i == 1 else [(k, self.tokens(texts[k])) for k in range(i, j)]  # find those that differ
            for k, x in found:
                if x is None:
                    good[k] = False
                else:
                    out.append((k, x))
        return out, good

    def __call__(self, texts: Iterable[str]) -> Aligned:
        """Aligns texts, each with its leading blank; '' and texts whose tokens' bytes differ have no stretch."""
        texts, known = list(texts), self.known
        stretch, ends = array("i"), array("q")
        for t in texts:
            if t:
                stretch.extend(map(known.place.__getitem__, split_at_seams(t) if self.seams else (t,)))
            ends.append(len(stretch))
        stretch, ends = np.array(stretch, np.int64), np.array(ends, np.int64)
        new = list(islice(known.place, len(known.size), None))
        # those that end in a blank, alone in their calls, after all others: the pieces of a call follow one another
        alone = np.array([not self.seams or t[-1].isspace() for t in new], bool)
        order = np.argsort(alone, kind="stable")
        size = np.array([len(t) if t.isascii() else len(t.encode()) for t in new], np.int64)
        found, good = self._many([new[k] for k in order.tolist()], int((~alone).sum()))
        del new
        right = np.empty(len(order), bool)
        right[order] = good
        known.add(found, right, size, order)
        del found
        # those of this block, as they came in it
        place = np.full(len(known.size), len(stretch), np.int32)
        place[stretch[::-1]] = np.arange(len(stretch) - 1, -1, -1)
        own = np.flatnonzero(place < len(stretch))
        own = own[np.argsort(place[own])]
        place[own] = np.arange(len(own))
        known.seen[own] += 1
        every, end = known.tokens(own)
        good, stretch = known.good[own], place[stretch].astype(np.int64)
        if not good.all():  # what differs in a part may be right in the whole
            parts = [stretch[i:j] for i, j in zip(np.r_[0, ends[:-1]], ends)]
            bad = {d: texts[d] for d in np.unique(np.searchsorted(ends, np.flatnonzero(~good[stretch]), "right")).tolist()}
            place, more = {}, []
            for text in dict.fromkeys(bad.values()):
                whole = self.tokens(text)
                place[text] = -1
                if whole is not None:
                    place[text] = len(end)
                    shift = int(end[-1])
                    more.append(Tokens(whole.a, whole.a_end + shift, whole.b, whole.b_end + shift))
                    end = np.r_[end, shift + len(text.encode())]
            every = Tokens(*map(np.concatenate, zip(every, *more)))
            for d, text in bad.items():
                parts[d] = np.array([place[text]] if place[text] >= 0 else [], np.int64)
            stretch, ends = np.concatenate(parts), np.cumsum([len(x) for x in parts], dtype=np.int64)
        known.forget()
        return self._align(every, end, stretch, ends)

    def _align(self, t: Tokens, end: np.ndarray, stretch: np.ndarray, stretch_end: np.ndarray) -> Aligned:
        n = len(end)
        cuts = np.intersect1d(t.a_end, t.b_end, assume_unique=True)
        ga, gb = np.searchsorted(cuts, t.a_end), np.searchsorted(cuts, t.b_end)
        na, nb = np.bincount(ga, minlength=len(cuts)), np.bincount(gb, minlength=len(cuts))
        owner = np.searchsorted(end, cuts)
        sums = lambda v: np.bincount(owner, v, n).astype(np.int64)
        figures = [sums(na), sums(nb), sums(np.ones(len(cuts))), sums(na * nb)]
        # every token of A with every token of B in its group
        wide = na * nb > WIDE
        first = np.cumsum(nb) - nb
        times = np.where(wide, 0, nb)[ga]
        key = [np.repeat(t.a, times) << 32 | t.b[T.ranges(first[ga], times)]]
        of, count = [np.repeat(owner[ga], times)], [np.ones(len(key[0]), np.int64)]
        for g in np.flatnonzero(wide).tolist():
            i = int(na[:g].sum())
            x, m = np.unique(t.a[i:i + na[g]], return_counts=True)
            y, k = np.unique(t.b[first[g]:first[g] + nb[g]], return_counts=True)
            key.append((x[:, None] << 32 | y).ravel())
            of.append(np.full(len(key[-1]), owner[g]))
            count.append((m[:, None] * k).ravel())
        key, of, count = (np.concatenate(x) for x in (key, of, count))
        id_pair = _distinct(key)
        code = of * max(1, len(id_pair)) + np.searchsorted(id_pair, key)
        order = np.argsort(code)
        code, count = code[order], count[order]
        new = np.flatnonzero(np.r_[True, code[1:] != code[:-1]][:len(code)])
        links = np.add.reduceat(count, new) if len(new) else count
        code = code[new]
        pair_end = np.searchsorted(code, np.arange(1, n + 1) * max(1, len(id_pair)))
        # a1,a2|b1;a3|b2,b3
        last = lambda g: np.r_[g[1:] != g[:-1], True][:len(g)].astype(int)
        del key, of, order, first, times, new
        entry = np.concatenate([t.a + last(ga) * len(self.a_bytes.size), t.b + last(gb) * len(self.b_bytes.size) + 2 * len(self.a_bytes.size)])
        shown = self.shown[entry[np.argsort(np.r_[2 * ga, 2 * gb + 1], kind="stable")]].tolist()
        del entry
        to = np.cumsum(figures[0] + figures[1]).tolist()
        groups = ["".join(shown[i:j])[:-1] for i, j in zip([0, *to], to)]
        return Aligned(stretch, stretch_end, figures, groups, code % max(1, len(id_pair)), pair_end, links, id_pair)


def documents_with(x: Aligned, most: int = 1 << 17) -> np.ndarray:
    """How many documents hold each id pair: once for each document and pair (about ``most`` stretches at a time)."""
    n, pairs, out = max(1, len(x.pair_end)), max(1, len(x.id_pair)), np.zeros(len(x.id_pair), np.int64)
    count, first = np.diff(x.pair_end, prepend=0), np.r_[0, x.pair_end[:-1]]
    per_doc, at = np.diff(x.stretch_end, prepend=0), 0
    while at < len(per_doc):
        i = int(x.stretch_end[at] - per_doc[at])
        to = max(at + 1, int(np.searchsorted(x.stretch_end, i + most, "right")))
        held = _distinct(np.repeat(np.arange(to - at), per_doc[at:to]) * n + x.stretch[i:int(x.stretch_end[to - 1])])
        own = held % n
        both = _distinct(np.repeat(held // n, count[own]) * pairs + x.pair[T.ranges(first[own], count[own])])
        out += np.bincount(both % pairs, minlength=len(out))
        at = to
    return out


def per_document(x: Aligned, values: np.ndarray) -> np.ndarray:
    """Sums over the stretches of each document."""
    run = np.r_[0, np.cumsum(values[x.stretch])]
    return run[x.stretch_end] - run[np.r_[0, x.stretch_end[:-1]]] if len(x.stretch_end) else run[:0]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}
_INTS = {"stretch": "<i4", "stretch_end": "<i8", "pair": "<i4", "pair_end": "<i8", "times": "<i8"}
_BLOCK = ("block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, "
          "stretch binary, stretch_end binary, pair binary, pair_end binary, times binary, id_pair array<long>, n_docs array<long>")


def _packed(x: np.ndarray) -> bytes:
    raw = x.tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def _unpacked(value, kind: str) -> np.ndarray:
    raw = value.as_buffer()
    return np.frombuffer(pa.Codec("zstd").decompress(raw[8:], int.from_bytes(raw[:8].to_pybytes(), "little")), kind)


def _block(number: int, ids: list, x: Aligned) -> pa.RecordBatch:
    """One row for a block of documents: their figures, and their links by way of stretches and distinct pairs."""
    ends = x.stretch_end.tolist()
    sha = [hashlib.sha256(";".join([x.groups[k] for k in x.stretch[i:j].tolist()]).encode()).hexdigest() if j > i else "" for i, j in zip([0, *ends], ends)]
    one = lambda v, kind=pa.int64(): pa.array([v], pa.list_(kind))
    packed = [pa.array([_packed(getattr(x, c).astype(k))], pa.binary()) for c, k in _INTS.items()]
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int64()), one(ids), *[one(per_document(x, f)) for f in x.figures], one(sha, pa.string()),
         *packed, one(x.id_pair), one(documents_with(x))],
        ["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", *_INTS, "id_pair", "n_docs"])


def align_blocks(docs: DataFrame, a_path: str, b_path: str, block: int = BLOCK) -> DataFrame:
    """(doc_id, text) -> one row for each block of whole documents (:func:`_block`)."""
    def run(batches):
        if (a_path, b_path) not in _ALIGNERS:
            _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
        align, number = _ALIGNERS[a_path, b_path], TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0
        for b in batches:
            for part in T.pieces(b, "text", min(block, 1 << 20)):
                more = [" " + t if t else "" for t in part.column("text").to_pylist()]
                if texts and size + sum(map(len, more)) > block:
                    yield _block(number, ids, align(texts))
                    number, ids, texts, size = number + 1, [], [], 0
                ids += part.column("doc_id").to_pylist()
                texts += more
                size += sum(map(len, more))
        if ids:
            yield _block(number, ids, align(texts))
        T.release()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _BLOCK)


def align(docs: DataFrame, a_path: str, b_path: str, block: int = BLOCK) -> DataFrame:
    """Aligns the tokens of A and B in every row of ``docs`` (doc_id, text).

    Byte offsets where both a token of A and one of B end cut the tokens into
    groups; tokens of one group are linked, each of A with each of B. An id
    pair's count is the number of documents that hold it linked. Returns
    doc_id, n_a, n_b, n_groups, n_links, n_best (links whose count is the
    highest of their A id), count_sum (counts over all links) and
    groups_sha256 of the groups written as `a1,a2|b1;a3|b2,b3`.

    Character offsets of ``tokenizers`` and the spans of ``sentencepiece`` (its
    ``return_type="offset_mapping"``: the immutable proto, which this version
    no longer returns, as character offsets) are the coarse cuts, refined by
    decoded bytes inside a character. A seam before a blank or line feed splits
    a text without changing its tokens (:meth:`Aligner._seams`), so a stretch
    between seams is encoded and aligned once in a block.

    What moves is a block's distinct id pairs with their documents, about a
    million for a block of 4 MB at most in common text; the pair of a frequent
    word comes once from each block. Sums go back to the block they came from.

    Null and empty texts, and texts whose tokens' bytes differ from them (a
    text with U+2581, which B can't write), have no tokens: zeros, and '' for
    the hash. Repeated rows and ids count as documents of their own; a null
    doc_id stays null. An empty table gives an empty result; other columns are
    not read. A text longer than a block is a block.
    """
    blocks = stage(align_blocks(docs, a_path, b_path, block), "aligned")
    pairs = blocks.select("block", F.explode(F.arrays_zip("id_pair", "n_docs")).alias("p")).select("block", "p.*")
    counts = pairs.groupBy("id_pair").agg(F.sum("n_docs").alias("n")).withColumn("a", F.shiftright("id_pair", 32))
    # the window sees one row for each id of B at most
    best = counts.select("id_pair", "n", (F.col("n") == F.max("n").over(Window.partitionBy("a"))).alias("best"))
    back = (pairs.select("block", "id_pair").join(best, "id_pair").groupBy(F.col("block").alias("b_block"))
            .agg(F.collect_list(F.struct("id_pair", "n", "best")).alias("known")))

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                row = {c: b.column(c)[r] for c in b.schema.names}
                n_docs = len(row["doc_id"])
                x = Aligned(**{c: _unpacked(row[c], k) for c, k in _INTS.items()}, figures=[], groups=[], id_pair=row["id_pair"].values.to_numpy())
                known = row["known"].values
                n, best_ = np.zeros(len(x.id_pair), np.int64), np.zeros(len(x.id_pair), np.int64)
                if known is not None and len(known):
                    where = np.searchsorted(x.id_pair, known.field(0).to_numpy())
                    n[where] = known.field(1).to_numpy()
                    best_[where] = known.field(2).to_numpy(zero_copy_only=False)
                sums = []
                for value in (best_, n):  # over the links of a stretch, then over the stretches of a document
                    each = np.r_[0, np.cumsum(value[x.pair] * x.times)]
                    sums.append(per_document(x, each[x.pair_end] - each[np.r_[0, x.pair_end[:-1]]] if len(x.pair_end) else each[:0]))
                cols = [row[c].values for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
                for i in range(0, n_docs, 4096):
                    yield pa.RecordBatch.from_arrays([*[c.slice(i, 4096) for c in cols], *[pa.array(s[i:i + 4096]) for s in sums],
                                                      row["groups_sha256"].values.slice(i, 4096)], names)

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    schema = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in names)
    joined = blocks.drop("n_docs").join(back, F.col("block") == F.col("b_block"), "left").drop("b_block")
    return joined.mapInArrow(run, schema)


def op13_align(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from daystream.session import read_table
    return align(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
