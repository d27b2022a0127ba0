import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from daystream.llm import resample as R
from daystream.llm.crc import Joiner

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow_features(text, runs, buckets):
    w = WORD.findall((text or "").translate(FOLD))
    return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, runs + 1) for i in range(len(w) - k + 1)]


def slow(rows, target, runs=1, buckets=10_000, least=20, percent=10, seed=2024):
    f = [slow_features(t, runs, buckets) for _, t in rows]
    s, t = Counter(b for _, x in f for b in x), Counter(b for x in target for b in slow_features(x, runs, buckets)[1])
    big_s, big_t = float(sum(s.values())), float(sum(t.values()))
    gain = [math.floor(1000 * math.log((t[b] + 1.) * (big_s + buckets) / ((s[b] + 1.) * (big_t + buckets)))) for b in range(buckets)]
    out = []
    for (i, _), (n, x) in zip(rows, f):
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in x)
        out.append([i, len(x), w, w + math.floor(-1000 * math.log(-math.log((h + .5) / 2**32))), None, n])
    fit = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(fit[:percent * len(fit) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def fast(df, target, **k):
    return sorted(map(tuple, R.resample(df, target, **k).select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def make(rng, n):
    words = ["The", "cat", "CAT", "déjà", "x1", "漢字", "İstanbul", "naïve", "42", "a", "b", "straße", "🙂"]
    sep = [" ", "  ", "\n", ", ", "_", "\0", "-", "\x7f", "."]
    return "".join(rng.choice(words) + rng.choice(sep) for _ in range(n))


def test_crc_of_joined_parts():
    rng, j = random.Random(0), Joiner()
    parts = [(rng.randbytes(rng.randint(0, 9)), rng.randbytes(rng.choice([0, 1, 5, 300, 70_000]))) for _ in range(60)]
    a, b = (np.array([zlib.crc32(p[k]) for p in parts], np.uint32) for k in (0, 1))
    assert j.joined(a, b, np.array([len(y) for _, y in parts])).tolist() == [zlib.crc32(x + y) for x, y in parts]


def test_dictionary_meets_each_word_once():
    words = ["a", "ab", "b", "abc", "é", "漢字", "字"]
    text = " ab a  abc b é 漢字 字 a "
    got = R.Dictionary(words).scan(text)
    assert [(v & 0xFFFFFFFF, v >> 32) for v in got.tolist()] == [(zlib.crc32(w.encode()), len(w.encode())) for w in text.split()]
    assert not len(R.Dictionary([]).scan("  "))


def test_same_as_by_hand(spark, docs):
    rng = random.Random(5)
    rows = [(i, make(rng, rng.randint(0, 60))) for i in range(400)]
    rows += [(3, rows[3][1])] * 2 + [(None, make(rng, 30)), (500, None), (501, ""), (502, "-- \0 --"), (503, "cat " * 20), (504, "cat " * 19)]
    target = [make(rng, 40) for _ in range(10)] + [None, ""]
    t = spark.createDataFrame([(x, "clash") for x in target], "text string, doc_id string")
    for k in ({}, {"runs": 3, "buckets": 97, "least_words": 5, "percent": 33, "seed": 1}, {"runs": 2, "buckets": 1 << 17}):
        names = {"least_words": "least"}
        want = slow(rows, target, **{names.get(a, a): b for a, b in k.items()})
        assert fast(docs(rows).repartition(3).withColumn("weight", F.lit("c")), t, **k) == want


def test_blocks_do_not_matter(docs):
    rng = random.Random(6)
    rows = [(i, make(rng, 50)) for i in range(60)]
    a, b = (sorted(map(tuple, R.features(docs(rows), 2, 1000, block).collect()), key=str) for block in (300, 1 << 20))
    assert a == b


def test_ranks_with_ties_and_hot_keys(spark):
    df = spark.range(5000).select(F.when(F.col("id") < 3000, 7).otherwise(F.col("id")).alias("score"), "id").repartition(6)
    got = [r["rank"] for r in R.ranks(df, [F.desc("score"), F.asc("id")]).orderBy(F.desc("score"), "id").collect()]
    assert got == list(range(1, 5001))


def test_empty_tables(spark, docs):
    none = docs([(1, "x")]).limit(0)
    assert R.resample(none, none.select("text")).count() == 0
    rows = [(i, "one two three " * 9) for i in range(20)]
    assert fast(docs(rows), none.select("text")) == slow(rows, [])
