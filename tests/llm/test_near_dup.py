import random
from collections import Counter

import numpy as np
import pytest

from daystream.llm import near_dup as N
from daystream.llm import text as T

SF = "/root/testdata/sf0.001"


def shingle_counts(t, size=5):
    w = (t or "").encode().split()
    if not w:
        return Counter()
    return Counter(b" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1)))


def slow_similarity(a, b):
    sa, sb = sum(a.values()), sum(b.values())
    keys, total = set(a) | set(b), 0.0
    for i in a.keys() & b.keys():
        total += 1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in keys)
    return total


def slow(rows, threshold=0.8):
    """Components by comparing all pairs."""
    sets = [shingle_counts(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    where = {}
    for i, s in enumerate(sets):
        for k in s:
            where.setdefault(k, []).append(i)
    for i, s in enumerate(sets):
        near = Counter(j for k in s for j in where[k] if j < i)
        for j in near:
            if find(i) != find(j) and slow_similarity(s, sets[j]) >= threshold - 1e-12:
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), d), d)
    return {d: low[find(i)] for i, (d, _) in enumerate(rows)}


def test_similarity_is_probability_jaccard():
    rng = np.random.default_rng(1)
    for _ in range(30):
        a = Counter({int(k): int(rng.integers(1, 4)) for k in rng.integers(0, 20, 12)})
        b = Counter({int(k): int(rng.integers(1, 4)) for k in rng.integers(0, 20, 12)})
        arrays = [(np.array(sorted(x), np.uint64), np.array([x[k] for k in sorted(x)])) for x in (a, b)]
        assert N.similarity(*arrays[0], *arrays[1]) == pytest.approx(slow_similarity(a, b), abs=1e-12)


def test_registers_estimate_the_similarity():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(300)]
    other = base[:]
    for i in range(0, 300, 40):
        other[i] = "changed"
    texts = [" ".join(base), " ".join(other), " ".join(reversed(base))]
    import pyarrow as pa
    data, off = T.buffers(pa.array(texts))
    r, h, c = N.shingles(data, off, 5)
    sig = N.signatures(r, h, c, 3)
    want = slow_similarity(shingle_counts(texts[0]), shingle_counts(texts[1]))
    assert abs((sig[0] == sig[1]).mean() - want) < 0.15
    assert (sig[0] == sig[2]).mean() < 0.05


def test_provided_documents_match_all_pairs(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in d.collect()]
    got = {r.doc_id: r.component_id for r in N.near_duplicates(d).collect()}
    assert got == slow(rows)


def test_odd_rows(docs):
    rng = random.Random(5)
    long = " ".join(rng.choice("abcdefgh") * rng.randint(1, 5) for _ in range(20000))
    base = " ".join(f"word{i}" for i in range(100))
    rows = [(3, base), (1, base + " end"), (2, None), (5, ""), (6, "one two"), (7, "one  two"), (None, base), (8, long), (8, long), (9, base.replace("word50", "x"))]
    out = {}
    for r in N.near_duplicates(docs(rows)).collect():
        out.setdefault(r.doc_id, []).append(r)
    assert len(out[8]) == 2 and all(r.component_id == 8 and r.kept for r in out[8])
    assert out[2][0].component_id == 2 and out[5][0].component_id == 5
    assert out[7][0].component_id == 6 and out[7][0].class_id == 6 and not out[7][0].kept
    assert {out[i][0].component_id for i in (3, 1, None, 9)} == {1}
    assert out[3][0].class_id == 3 and out[None][0].class_id == 3
    assert N.near_duplicates(docs([])).count() == 0


def test_chain_of_links_is_one_component(docs):
    # neighbours in the chain are similar, the ends are not
    words = [f"t{i}" for i in range(160)]
    rows = [(i, " ".join(words[i * 4:i * 4 + 100])) for i in range(12)]
    assert {r.component_id for r in N.near_duplicates(docs(rows)).collect()} == set(slow(rows).values())
