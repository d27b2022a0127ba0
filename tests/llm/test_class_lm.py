import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from daystream.llm import class_lm as C


def HELD():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2


def is_held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def base(rows):
    texts = [(i, (t or "").encode().lower().split() + [None]) for i, t in rows]
    n = Counter(w for i, t in texts if not is_held(i) for w in t)
    total, types = sum(n.values()), len(n)
    return [(i, is_held(i), len(t), sum(n[w] > 0 for w in t), total, sum(math.log10((n[w] + 1) / (total + types + 1)) for w in t)) for i, t in texts]


def check_base(rows, out):
    key = lambda x: (str(x[0]), *x[2:4], round(x[5], 6))
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in out), key=key)
    for a, b in zip(got, sorted(base(rows), key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-6)


def test_provided_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    out = C.class_scores(d, HELD()).collect()
    check_base([tuple(r) for r in d.collect()], out)
    held = [r for r in out if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_clusters_follow_the_language(spark, docs):
    rng = random.Random(1)
    noun, verb, det = [f"n{i}" for i in range(30)], [f"v{i}" for i in range(30)], ["the", "a"]
    rows = [(i, " ".join(w for _ in range(30) for w in (rng.choice(det), rng.choice(noun), rng.choice(verb)))) for i in range(300)]
    out = C.class_scores(docs(rows), HELD()).collect()
    held = [r for r in out if r.held_out]
    # a word's share in its class, as in the grammar, is about 1/30, 1/30 and 1/2
    per = sum(r.score for r in held) / sum(r.n_tokens - 1 for r in held)
    assert per == pytest.approx((2 * math.log10(1 / 30) + math.log10(1 / 2)) / 3, abs=0.05)
    assert per > sum(r.base_score for r in held) / sum(r.n_tokens for r in held) + 0.3


def test_exchange_reaches_a_better_likelihood():
    rng = np.random.default_rng(4)
    true = rng.integers(0, 4, 40)
    flow = rng.dirichlet(np.ones(4) * .3, 4)
    pairs = np.zeros((42, 42))
    pairs[:40, :40] = rng.poisson(50 * flow[true][:, true])
    cls = C.exchange(pairs, 4)

    def gain(c):
        m = np.zeros((8, 8))
        np.add.at(m, (c[:, None], c[None, :]), pairs[:40, :40])
        p = m / m.sum()
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.nansum(p * np.log(p / (p.sum(1, keepdims=True) * p.sum(0, keepdims=True))))
    assert gain(cls) >= 0.98 * gain(true) and gain(cls) > gain(np.arange(40) % 4)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(5)
    k = C.UNKNOWN + 1
    pairs = np.stack([rng.integers(0, 30, (k, k)), rng.integers(0, 3, (k, k))]).astype(float)
    pairs[0, :, C.UNKNOWN] = 0
    p, _ = C.model(pairs)
    assert np.allclose((10 ** p).sum(1), 1)


def test_odd_rows(docs):
    rows = [(1, None), (2, ""), (3, "A a À à"), (3, "A a À à"), (None, "b\x0bb c"), (5, "w " * 30000), (6, "\n"), (11, "unseen words"), (4, "new")]
    assert any(is_held(i) for i, _ in rows)
    check_base(rows, C.class_scores(docs(rows), HELD()).collect())
    assert all(math.isfinite(r.score) and r.score <= 0 for r in C.class_scores(docs(rows), HELD()).collect())
    none = C.class_scores(docs(rows), F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens, r.base_score, r.score) for r in none} == {(0, 0, 0.0, 0.0)}
    assert C.class_scores(docs([]), HELD()).count() == 0


def grammar(seed, n, most):
    """Texts of a grammar whose nouns and verbs are many and rare, with frequent words around them."""
    rng = random.Random(seed)
    noun, verb, det = [f"n{i}" for i in range(most)], [f"v{i}" for i in range(most)], ["the", "a"]
    return [(i, " ".join(w for _ in range(30) for w in (rng.choice(det), rng.choice(noun), rng.choice(verb)))) for i in range(n)]


def test_scores_do_not_depend_on_blocks_or_partitions(docs):
    d = docs(grammar(2, 400, 150))
    kept = []
    for parts, block in ((1, 8 << 20), (7, 2000), (3, 20000)):
        out = C.class_scores(d.repartition(parts, "doc_id"), HELD(), 4, 20, block=block).collect()
        kept.append(sorted((r.doc_id, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in out))
    assert kept[0] == kept[1] == kept[2]


def test_heads_are_counted_in_every_block(docs):
    # a word of every block that is under one token in 8,192 of each
    rows = [(i, " ".join(f"x{i}_{j}" for j in range(9000)) + " common" * (1 + (i % 2))) for i in range(6)]
    blocks = C.encode(docs(rows).repartition(6, "doc_id"), F.lit(False), 1)
    assert len(C.heads(blocks, 4, 5)) == 5
    first = C.T.span_hash(np.frombuffer(b"common", np.uint8), np.array([0]), np.array([6]), 0)
    assert C.heads(blocks, 4, 1).tolist() == first.tolist()


def test_words_that_are_no_heads_are_exchanged(docs):
    rows = grammar(3, 400, 150)
    out = [r for r in C.class_scores(docs(rows), HELD(), 4, 20).collect() if r.held_out]
    # few nouns and verbs are heads; the others are told apart by what is around them
    per = sum(r.score for r in out) / sum(r.n_tokens - 1 for r in out)
    assert per == pytest.approx((2 * math.log10(1 / 150) + math.log10(1 / 2)) / 3, abs=0.08)
