import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from daystream.llm import suffix_dedup as D
from daystream.llm.lyndon import suffix_arrays


def slow(rows, width=50):
    order = lambda d: (d is None, d)
    first, out = {}, []
    texts = [(d, (t or "").encode()) for d, t in rows]
    for d, b in texts:
        for i in range(len(b) - width + 1):
            k = b[i:i + width]
            first[k] = min(first.get(k, order(d)), order(d))
    for d, b in texts:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - width + 1):
            if first[b[i:i + width]] < order(d):
                gone[i:i + width] = True
        kept = bytes(x for i, x in enumerate(b) if not gone[i])
        runs = sum(gone[i] and (i == 0 or not gone[i - 1]) for i in range(len(b)))
        out.append((d, len(b), int(gone.sum()), int(runs), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(df, **kw):
    return sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in D.suffix_dedup(df, with_text=False, **kw).collect()], key=str)


def test_suffix_arrays_equal_sorting():
    rng = random.Random(1)
    for _ in range(120):
        texts = []
        for _ in range(rng.randint(1, 8)):
            t = [rng.randint(1, rng.choice([1, 2, 3, 26])) for _ in range(rng.randint(0, 40))]
            texts.append(t * rng.randint(1, 4) + [0])
        off = np.r_[0, np.cumsum([len(t) for t in texts])]
        sa = suffix_arrays(np.array(sum(texts, [])), off)
        for i, t in enumerate(texts):
            assert (sa[off[i]:off[i + 1]] - off[i]).tolist() == sorted(range(len(t)), key=lambda x: t[x:])


def test_random_passages(docs):
    for seed, largest in ((0, 1 << 14), (1, 300), (2, 1 << 14), (3, 100)):
        rng = random.Random(seed)
        alphabet = "ab é" if seed != 1 else "a"
        shared = ["".join(rng.choice(alphabet) for _ in range(rng.randint(30, 160))) for _ in range(6)]
        rows = []
        for _ in range(50):
            t = ""
            for _ in range(rng.randint(0, 5)):
                p = rng.choice(shared)
                s = rng.randint(0, len(p) // 2)
                t += p[s:rng.randint(s, len(p))] if rng.random() < .7 else "".join(rng.choice("xyz\n") for _ in range(rng.randint(0, 90)))
            rows.append((rng.randint(0, 10 ** 12), t))
        assert run(docs(rows), largest=largest) == slow(rows)


def test_many_branches_around_one_anchor():
    """5,000 different strings around one anchor: split until they fit, and sorted, never settled by a hash of windows."""
    rng = random.Random(7)
    core = "a passage that many documents share, word for word"
    strings = ["".join(rng.choice("abcd") for _ in range(12)) + core + "".join(rng.choice("abcd") for _ in range(12)) for _ in range(5000)]
    bodies = [s.encode() for s in strings]
    rel = 12 + 17
    n = len(strings)
    lo, count = rel - 34, 35
    cut = [b[lo if lo > 0 else 0:][:84] for b in bodies]
    rel = rel - max(lo, 0)
    count = [len(b) - 49 for b in cut]
    pack = lambda x, kind: [np.asarray(x, kind).tobytes()]
    table = pa.table({"anchor": pack([5] * n, "<u8"), "rank": pack(range(n), "<i8"), "uid": pack(range(n), "<i8"), "lo": pack([0] * n, "<i4"),
                      "count": pack(count, "<u2"), "rel": pack([rel] * n, "<u2"), "body": [b"".join(cut)]})
    calls = []
    with pytest.MonkeyPatch.context() as m:
        m.setattr(D, "suffix_arrays", lambda sym, off: calls.append(int(np.diff(off).max())) or suffix_arrays(sym, off))
        got = {(int(w), int(a)) for who, at in D._repeats(D._Group(table, 50, 16), 50, D.LARGEST) for w, a in zip(who, at)}
    assert calls and max(calls) <= D.LARGEST + 1
    first, want = {}, set()
    for i, b in enumerate(cut):
        for w in range(count[i]):
            if rel - 34 <= w <= rel and first.setdefault(b[w:w + 50], i) < i:
                want.add((i, w))
    assert got == want and len(want) > 5000


def test_odd_rows(docs):
    p = "The quick brown fox jumps over the lazy dog, twice over and over again."
    rows = [(5, p), (2, "x" + p + "y"), (None, p), (7, None), (8, ""), (9, "z" * 4000), (10, "z" * 51), (11, p), (11, p),
            (2, "other" + p), (12, p[:49]), (13, "é" * 200), (14, "é" * 30), (15, p[:50]), (16, p[1:51] + p[:50])]
    assert run(docs(rows)) == slow(rows)
    assert run(docs([])) == []
    for r in D.suffix_dedup(docs([(1, p), (2, "vorn " + p + " hinten")])).collect():
        assert r.text == p or r.text == "vorn  hinten"
