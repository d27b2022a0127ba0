import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from daystream.llm import line_dedup as L

FOLD = str.maketrans(L.UPPER, L.LOWER)


def slow(rows, least_chars=40, least_docs=5):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(FOLD)
    held = defaultdict(set)
    late = lambda i: (i is None, i or 0)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least_chars:
                held[key(line)].add(late(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(held[key(x)]) < least_docs or late(i) == max(held[key(x)])]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def fast(df, **k):
    return sorted(map(tuple, L.line_dedup(df, **k).collect()), key=str)


def test_random_lines(docs):
    rng = random.Random(3)
    pool = ["Licence " + "x" * n for n in (31, 32, 40, 90)] + ["Ünï " * 10, "ÉCOLE " * 9, "short", "", "  \t", "a" * 39, "漢" * 40]
    rows = []
    for i in range(300):
        lines = [rng.choice(pool) for _ in range(rng.randint(0, 12))]
        lines = [rng.choice(["", " ", "\t\r"]) + (x.upper() if rng.random() < .3 and x.isascii() else x) + rng.choice(["", " \x0b", "\x0c"]) for x in lines]
        rows.append((i, "\n".join(lines)))
    rows += [(7, rows[7][1])] * 3 + [(7, "Licence " + "x" * 40 + "\nelse"), (None, "Licence " + "x" * 40), (None, "x\n" + "漢" * 40),
             (9001, None), (9002, ""), (9003, "\n\n"), (9004, "a" * 40 + " "), (9005, "a" * 40)]
    rows += [(9100 + i, "\n".join(["seen " * 20] * 200 + [f"own line {i}"])) for i in range(6)]  # words of the bitmap without a gap
    rows += [(9200 + i, "\n".join([f"own line {i}"] * 500 + ["end " * 20])) for i in range(6)]  # and with one
    assert fast(docs(rows)) == slow(rows)
    assert fast(docs(rows).repartition(5), least_docs=2) == slow(rows, least_docs=2)


def test_exactly_least(docs):
    line = "k" * 40
    for n in (4, 5):
        out = fast(docs([(i, line + "\nrest") for i in range(n)]))
        assert sum(r[2] for r in out) == (0 if n < 5 else 4) and out[-1][2] == 0


def test_hot_line_is_dealt_to_shards(spark, docs):
    rows = [(i, "the same licence line in a third of all documents\nown " + str(i)) for i in range(3000)] + [(9000 + i, "x") for i in range(6000)]
    out = L.line_dedup(docs(rows))
    assert out.agg(F.sum("n_dropped")).first()[0] == 2999
    heads = L.line_hashes(docs(rows)).select("h1", "h2", F.pmod(F.xxhash64("doc"), F.lit(L.SHARDS)).alias("s")).groupBy("h1", "h2", "s").count()
    assert heads.agg(F.max("count")).first()[0] < 3000 / L.SHARDS * 2


def test_bitmaps_are_sparse(docs):
    rows = [(i, "\n".join(["-"] * 1000 + ["the end of many a document, as it is written here"])) for i in range(6)]
    out = L.line_bitmaps(docs(rows)).collect()
    assert len(out) == 5 and all(len(r.dropped) == 1 and r.dropped[0].word == 1000 // L.BITS and r.n_dropped == 1 for r in out)


def test_empty_extra_and_native(docs):
    assert L.line_dedup(docs([]).limit(0)).count() == 0
    df = docs([(1, "a\nb")]).withColumn("lines", F.lit("clash")).withColumn("doc", F.lit(5)).withColumn("n_dropped", F.lit("c"))
    r = L.line_dedup(df, extra=("lines", "doc", "n_dropped")).first()
    assert (r.text, r.n_lines, r.row.lines, r.row.doc) == ("a\nb", 2, "clash", 5)
    plan = L.line_dedup(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan


def test_digest(spark):
    got = L.op12_line_dedup(spark, "/root/testdata/sf0.001").collect()
    want = slow([(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()])
    assert sorted(map(tuple, got), key=str) == sorted(((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in want), key=str)
