"""Packing tokenized documents into fixed sequences: concatenate and cut."""

from __future__ import annotations

import zlib
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daystream.llm import text as T
from daystream.llm.store import stage


def _byte_bpe(spec: dict):
    """A faster encoder with the same ids, for plain byte-level BPE vocabularies.

    Only where the file has no normalizer, the standard byte-level split, and
    ids in the order of its merges (then a rank table says the same as the list
    of merges); else None, and the file's own tokenizer does it.
    """
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (spec.get("normalizer") is None and model.get("type") == "BPE" and pre.get("type") == "ByteLevel"
             and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not model.get("dropout")
             and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix") and not model.get("unk_token"))
    if not plain:
        return None
    # byte-level vocabularies write byte b as chr(b) if that is printable, else as the next of chr(256)...
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(shown)]
    to_byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(other)}
    vocabulary = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merged = [vocabulary["".join(m)] for m in pairs]
    if merged != sorted(merged):
        return None
    special = {t["content"] for t in spec.get("added_tokens", [])}
    import tiktoken
    ranks = {bytes(to_byte[c] for c in w): i for w, i in vocabulary.items() if w not in special}
    return tiktoken.Encoding("plain", pat_str=GPT_SPLIT, mergeable_ranks=ranks, special_tokens={})


#: Fixed value: the byte-level pre-tokenizer's published split pattern.
GPT_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class _Pieces(dict):
    """Ids of the pieces met so far; None for a piece that can't stand alone.

    The byte-level pre-tokenizer always starts a new piece before a space and
    around a line feed if no other white space is beside them.
    """

    def __init__(self, encode):
        super().__init__({"": b""})
        self.encode = encode

    def __missing__(self, piece: str):
        body = piece[1:] if piece[0] == " " else piece
        alone = piece == "\n" or (body != "" and not body[0].isspace() and not body[-1].isspace())
        self[piece] = ids = self.encode([piece])[0] if alone else None
        return ids


class Encoder:
    """Ids of whole texts, with a bounded memory of the ids of pieces.

    The ids of a text are those of its pieces, cut before spaces and around
    line feeds, one after another; a piece met before costs a dictionary
    look-up. Texts with white space beside white space are encoded whole.
    Special token strings in a text are ordinary text, or with
    ``special_tokens`` what the file's own tokenizer makes of them.
    """

    def __init__(self, path: str, most: int = 250_000, special_tokens: bool = False):
        import json

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = [t["content"] for t in spec.get("added_tokens", [])]
        self.path, self.special_tokens = path, special_tokens
        self.special = added if special_tokens else []
        self.fast = _byte_bpe(spec)
        size = len({*spec["model"]["vocab"], *added}) if self.fast is not None else self.tok.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 65536 else "<u4")
        self.most = most
        self.forget()
        del spec
        T.release()

    @cached_property
    def tok(self):
        """The file's own tokenizer, built when a text needs it."""
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(self.path)
        tok.encode_special_tokens = not self.special_tokens
        return tok

    def forget(self) -> None:
        self.known = _Pieces(self._encode)

    def _encode(self, texts: list[str]) -> list[bytes]:
        if self.fast is not None:
            one = self.fast.encode_ordinary
            return [np.array(one(t), self.dtype).tobytes() for t in texts]
        return [np.array(e.ids, self.dtype).tobytes()
                for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.most:
            self.forget()
        get, out = self.known.__getitem__, []
        for t in texts:
            if any(x in t for x in self.special):
                out.append(np.array(self.tok.encode(t, add_special_tokens=False).ids, self.dtype).tobytes())
                continue
            if "\n\n" not in t and "\0" not in t:
                try:
                    out.append(b"".join(map(get, t.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0"))))
                    continue
                except TypeError:  # a piece without ids of its own
                    pass
            out += self._encode([t])
        return out


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def _encoder(path: str, special_tokens: bool = False) -> Encoder:
    if (path, special_tokens) not in _ENCODERS:
        _ENCODERS[path, special_tokens] = Encoder(path, special_tokens=special_tokens)
    return _ENCODERS[path, special_tokens]


def tokenize(docs: DataFrame, tokenizer: str, end_id: int = 0, special_tokens: bool = False) -> DataFrame:
    """(doc_id, text) -> (part, local_start, doc_id, n, ids), one row a document.

    ``ids`` holds the document's ids and ``end_id`` as little-endian integers
    of ``n`` equal widths; ``part`` is the scan task and ``local_start`` the
    tokens before the document in it.
    """
    def run(batches):
        enc, part, at = _encoder(tokenizer, special_tokens), TaskContext.get().partitionId(), 0
        end = np.array([end_id], enc.dtype).tobytes()
        for b in batches:
            col = b.column(1).fill_null("")
            for i in range(0, b.num_rows, 256):  # bounds the Python strings in memory
                rows = col.slice(i, 256).to_pylist()
                ids = [x + end for x in enc(rows)]
                n = np.array([len(x) // enc.dtype.itemsize for x in ids], np.int64)
                starts = at + np.r_[0, np.cumsum(n)[:-1]]
                at += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), part, np.int64)), pa.array(starts), b.column(0).slice(i, 256),
                     pa.array(n), pa.array(ids, pa.binary())], ["part", "local_start", "doc_id", "n", "ids"])
        enc.forget()  # the worker lives on
        T.release()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "part long, local_start long, doc_id long, n long, ids binary")


def pack(docs: DataFrame, tokenizer: str, length: int = 1024, end_id: int = 0, with_ids: bool = True, special_tokens: bool = False) -> DataFrame:
    """Pack all rows of ``docs`` (doc_id, text) into sequences of ``length`` tokens.

    Pass one tokenizes once and stages the ids with each scan task's running
    token count; the totals of the tasks are prefix-summed to global offsets
    (one row per scan task). Pass two adds the task's offset to each document,
    and cuts it at the multiples of ``length``: a document that crosses one
    gives a record on either side. Only the last sequence is shorter, so
    padding is under one sequence in all, and nothing but the totals moves.

    Returns one row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and, if ``with_ids``, ids (little-endian 32-bit).
    With ``special_tokens`` a special token's string in a text is that token's id,
    as ``tokenizers`` has it by default, else ordinary text.
    Null and empty texts are one ``end_id``. Repeated rows and repeated or null
    ids are packed as rows of their own; other columns are not read. An empty
    table gives an empty result. The order of documents is the scan's.
    """
    spark = docs.sparkSession
    t = stage(tokenize(docs, tokenizer, end_id, special_tokens), "tokens")
    totals = t.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per scan task (16 bytes for at least tens of MB of text), so this broadcast is bounded
    base = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = t.join(F.broadcast(base), "part").select(
        "doc_id", "n", "ids", (F.col("base") + F.col("local_start")).alias("at"))

    def cut(batches):
        for b in batches:
            n, at = b.column(1).to_numpy(), b.column(3).to_numpy()
            out = [[] for _ in range(8)]
            for i, blob in enumerate(b.column(2)):
                raw = np.frombuffer(blob.as_buffer(), "<u1")
                ids = raw.view("<u2" if len(raw) == 2 * n[i] else "<u4").astype("<u4")
                doc, g, k, total = b.column(0)[i].as_py(), int(at[i]), 0, int(n[i])
                while k < total:
                    size = min(total - k, length - (g + k) % length)
                    piece = ids[k:k + size].tobytes()
                    for o, v in zip(out, (doc, k, size, zlib.crc32(piece), total, (g + k) // length, (g + k) % length, piece)):
                        o.append(v)
                    k += size
                if len(out[0]) >= 4096 or i == b.num_rows - 1:
                    cols = [pa.array(o, pa.int64()) for o in out[:7]] + ([pa.array(out[7], pa.binary())] if with_ids else [])
                    yield pa.RecordBatch.from_arrays(cols, names)
                    out = [[] for _ in range(8)]

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    schema = ", ".join(f"{c} {'binary' if c == 'ids' else 'long'}" for c in names)
    return placed.mapInArrow(cut, schema)


def tokenizer_path() -> str:
    """The production vocabulary: a public file, by its place on this machine."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op4_pack(spark, sf_dir: str) -> DataFrame:
    from daystream.session import read_table
    return pack(read_table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False, special_tokens=True)
