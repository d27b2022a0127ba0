import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from daystream.llm import toxicity as X


def corpus(n=1500, seed=1):
    """Texts of random words; toxic ones hold two or more words of a made-up lexicon, some of them inflected."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeiou") + rng.choice("bcdfglmnprst") for _ in range(rng.randint(1, 4))) for _ in range(400)]
    bad = ["zgrok", "zblem", "zwurb"]
    rows, labels = [], []
    for i in range(n):
        w = [rng.choice(words) for _ in range(rng.randint(5, 200))]
        toxic = int(rng.random() < 0.15)
        if toxic:
            for _ in range(rng.randint(2, 4)):
                w.insert(rng.randrange(len(w)), rng.choice(bad) + rng.choice(["", "s", "ing", ",", "ish."]))
        rows.append((i, " ".join(w).capitalize()))
        labels.append((i, 1, toxic))
    return rows, labels


def test_held_out_rows(spark, docs):
    rows, labels = corpus()
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    out = X.toxicity(docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
                     ~(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)).collect()
    truth = {i: t for i, _, t in labels}
    test = [(r.predicted, truth[r.doc_id]) for r in out if held(r.doc_id)]
    assert len(test) > 200
    assert sum(p for p, t in test if t) / sum(t for _, t in test) > 0.95
    assert sum(p for p, t in test if not t) / sum(not t for _, t in test) < 0.02
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)


def _recall(spark, docs, rows, labels):
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    out = X.toxicity(docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
                     ~(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)).collect()
    truth = {i: t for i, _, t in labels}
    test = [(r.predicted, truth[r.doc_id]) for r in out if held(r.doc_id)]
    return (sum(p for p, t in test if t) / sum(t for _, t in test),
            sum(p for p, t in test if not t) / sum(not t for _, t in test))


def _plain(rng, words, n):
    """A text of ``n`` words, the first ones of ``words`` more often."""
    return [words[int(len(words) * rng.random() ** 3)] for _ in range(n)]


def test_words_that_recur_in_five_toxic_documents(spark, docs):
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("aeiou") + rng.choice("bcdfglmnprst") for _ in range(rng.randint(1, 4))) for _ in range(3000)})
    bad = [f"{a}q{b}x{c}" for a in "aeio" for b in "aeiou" for c in "aeiou"]
    rows, labels = [], []
    for i in range(3300):
        w, toxic = _plain(rng, words, rng.randint(20, 80)), int(i % 11 == 0)
        if toxic:
            w.insert(rng.randrange(len(w)), bad[i // 11 % 60])  # every word in exactly five toxic documents
        rows.append((i, " ".join(w)))
        labels.append((i, 1, toxic))
    found, wrong = _recall(spark, docs, rows, labels)
    assert found >= 0.9 and wrong < 0.01, (found, wrong)


def test_pairs_of_ordinary_words(spark, docs):
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("aeiou") + rng.choice("bcdfglmnprst") for _ in range(rng.randint(1, 4))) for _ in range(3000)})
    rows, labels = [], []
    for i in range(3300):
        w, toxic = _plain(rng, words, rng.randint(20, 80)), int(i % 11 == 0)
        if toxic:
            k = rng.randrange(len(w))
            w[k:k] = ["zold", "zorb"]
        elif i % 33 == 1:
            w.insert(rng.randrange(len(w)), rng.choice(["zold", "zorb"]))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, toxic))
    found, wrong = _recall(spark, docs, rows, labels)
    assert found >= 0.9 and wrong < 0.01, (found, wrong)


def test_chance_gives_no_patterns(spark, docs):
    rng = random.Random(6)
    words = sorted({"".join(rng.choice("aeiou") + rng.choice("bcdfglmnprst") for _ in range(rng.randint(1, 4))) for _ in range(3000)})
    rows = [(i, " ".join(_plain(rng, words, 50))) for i in range(2000)]
    labels = [(i, 1, int(rng.random() < 0.1)) for i in range(2000)]
    assert _recall(spark, docs, rows, labels)[1] < 0.01


def test_a_labelled_id_met_often_counts_once(spark, docs):
    rows, labels = corpus(400)
    schema = "doc_id long, quality int, toxic int"
    often = rows + [(3, f"copy {i}") for i in range(2000)]
    one, two = (X.fit(docs(r), spark.createDataFrame(labels, schema)) for r in (rows, often))
    assert one is not None and two is not None and abs(len(one[0]) - len(two[0])) < 50


def test_label_model_without_gold_start():
    rng = np.random.default_rng(3)
    y = rng.random(5000) < 0.2
    votes = np.stack([np.where(y, rng.random(5000) < a, rng.random(5000) < b) for a, b in
                      ((.6, .01), (.5, .02), (.4, .002), (.3, .01), (.5, .001))], 1).astype(float)
    post, rates = X.label_model(votes, 0.2)
    assert ((post > 0.5) == y).mean() > 0.93
    assert np.abs(rates[:5, 0] - np.array([.6, .5, .4, .3, .5])).max() < 0.12


def test_labels_of_held_out_rows_are_not_read(spark, docs):
    rows, labels = corpus(600)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    flip = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    schema = "doc_id long, quality int, toxic int"
    a, b = (sorted((r.doc_id, r.score) for r in X.toxicity(docs(rows), spark.createDataFrame(x, schema), ~held).collect()) for x in (labels, flip))
    assert a == b


def test_correlated_voters_weigh_as_one():
    rng = np.random.default_rng(2)
    y = rng.random(4000) < 0.3
    fire = lambda a, b: np.where(y, rng.random(4000) < a, rng.random(4000) < b).astype(float)
    one, two, three = fire(.8, .02), fire(.7, .03), fire(.6, .03)
    post, rates = X.label_model(np.stack([one, two, three, three, three, three], 1), 0.3)
    assert ((post > 0.5) == y).mean() > 0.9
    assert rates[2:6, 2].max() < 0.5 < rates[0, 2]
    assert abs(rates[0, 0] - 0.8) < 0.1 and rates[0, 1] < 0.08


def test_odd_rows(spark, docs):
    rows, labels = corpus(400)
    odd = [(9001, None), (9002, ""), (None, "zgrok zblem zwurbs zgrok"), (9003, "zgrok " * 30000), (9003, "zgrok " * 30000), (9004, "\n\t")]
    lab = labels + [(5, 1, None), (None, 1, 1), (7, 1, 2), (8, 1, 0), (8, 1, 1), (77777, 1, 1)]
    schema = "doc_id long, quality int, toxic int"
    out = X.toxicity(docs(rows + odd), spark.createDataFrame(lab, schema)).collect()
    assert len(out) == len(rows) + len(odd)
    by = {r.doc_id: r for r in out}
    assert by[9001].score == by[9002].score == by[9004].score < 0.3
    assert by[None].predicted == 1 and by[9003].predicted == 1
    none = X.toxicity(docs(odd), spark.createDataFrame([], schema)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)}
    assert X.toxicity(docs([]), spark.createDataFrame(labels, schema)).count() == 0
