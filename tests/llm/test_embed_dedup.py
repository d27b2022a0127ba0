import numpy as np
import pytest
from pyspark.sql import functions as F

from daystream.llm import embed_dedup as E

SCHEMA = "vec_id long, embedding array<float>, label int"


def slow(rows, threshold=0.98):
    n = len(rows)
    x = [None] * n
    for i, (_, e, label) in enumerate(rows):
        if label is not None and e and all(v is not None and np.isfinite(v) for v in e) and any(e):
            v = np.array(e, np.float32).astype(np.float64)
            x[i] = v / np.sqrt((v * v).sum())
    links, parent = [0] * n, list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(n):
        for j in range(i):
            if x[i] is not None and x[j] is not None and rows[i][2] == rows[j][2] and len(x[i]) == len(x[j]) and x[i] @ x[j] >= threshold:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[find(i)] = min(low.get(find(i), r[0]), r[0])
    return sorted(((r[0], links[i], low.get(find(i)), low.get(find(i)) == r[0]) for i, r in enumerate(rows)), key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("node", F.lit("clash")).withColumn("ok", F.lit(0))
    return sorted([tuple(r) for r in E.embedding_duplicates(df, **kw).collect()], key=str)


@pytest.mark.parametrize("tile", [2048, 16])
def test_groups_of_all_sizes(spark, tile):
    rng = np.random.default_rng(3)
    rows = []
    for g in range(20):
        c = rng.standard_normal(32)
        for _ in range([1, 2, 60][g % 3]):
            rows.append((len(rows) * 7 % 100003, (c + rng.standard_normal(32) * rng.choice([0.0, 0.05, 0.14])).astype(np.float32).tolist(), g % 3))
    assert run(spark, rows, tile=tile) == slow(rows)


def test_recall_at_the_threshold(spark):
    """Pairs just above the threshold, many of them, all found."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(300):
        a = rng.standard_normal(64)
        b = rng.standard_normal(64)
        a /= np.linalg.norm(a)
        b -= a * (a @ b)
        b /= np.linalg.norm(b)
        c = 0.981
        rows += [(2 * i, a.astype(np.float32).tolist(), 0), (2 * i + 1, (c * a + np.sqrt(1 - c * c) * b).astype(np.float32).tolist(), 0)]
    assert run(spark, rows) == slow(rows)


def test_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 0), (2, [2.0, 4.0, 6.0], 0), (3, v, 1), (4, v, None), (5, None, 0), (6, [0.0, 0.0, 0.0], 0), (7, [1.0, None, 3.0], 0), (8, [1.0, float("nan"), 3.0], 0),
            (9, [float("inf"), 1.0, 1.0], 0), (10, [], 0), (11, [1.0, 2.0], 0), (12, [-1.0, -2.0, -3.0], 0), (None, v, 0), (1, v, 0), (13, v, 1), (None, [5.0, -1.0, 0.0], 2),
            (14, [0.0, 1.0, 0.0], 3), (15, [-0.0, 1.0, 0.0], 3), (4, v, None)]
    got = run(spark, rows)
    want = slow(rows)
    assert [r[:3] for r in got if r[0] is not None] == [r[:3] for r in want if r[0] is not None]
    assert [r[:3] for r in got if r[0] is None] == [r[:3] for r in want if r[0] is None]
    assert run(spark, []) == []


def test_enough_tables_for_every_size():
    for n in (2, 100, 10 ** 4, 10 ** 6, 10 ** 9):
        bits, tables = E.shape(n)
        p = (1 - np.arccos(0.98) / np.pi) ** bits
        assert (1 - p) ** tables <= 1e-4
