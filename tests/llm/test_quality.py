import random
import re

import numpy as np
import pyarrow as pa
import pytest

from daystream.llm import linear
from daystream.llm import quality as Q
from daystream.llm import text as T

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow(t):
    t = t or ""
    words = WORD.findall(t)
    lines, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    seen = {}
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i:i + 3]), []).append(i)
    marked = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 3)}
    failed = len(words) < 50 or 100 * len(marked) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(marked), failed


def measured(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_provided_documents(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    label = {r.doc_id: r.quality for r in labels.collect()}
    good = total = 0
    for r in Q.quality(docs, labels).collect():
        assert measured(r) == slow(texts[r.doc_id])
        assert r.kept == (not r.base_failed and r.score >= Q.THRESHOLD)
        if r.doc_id in label and not r.base_failed:
            total += 1
            good += r.kept == bool(label[r.doc_id])
    assert good / total > 0.97


def test_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    label = {r.doc_id: r.quality for r in labels.collect()}
    out = Q.quality(docs, labels.filter("doc_id % 3 <> 0")).collect()
    held = [(r.kept, bool(label[r.doc_id])) for r in out if r.doc_id in label and r.doc_id % 3 == 0 and not r.base_failed]
    assert sum(a == b for a, b in held) / len(held) > 0.95


@pytest.mark.parametrize("with_labels", [True, False])
def test_odd_rows(spark, docs, with_labels):
    rng = random.Random(3)
    many = "\n".join(" ".join(rng.choice(["aa", "é|", "c#", "dd", "long-word", "漢字"]) for _ in range(rng.randint(0, 9))) for _ in range(300))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a b c a b c"), (5, "x\nx\n\nx \nx"), (6, many), (6, many), (None, "one two three " * 40),
            (7, " ".join(f"w{i}" for i in range(80))), (8, "\n\na\n"), (9, "z"), (10, "# " * 60), (11, "a\rb\x0bc\x0cd e")]
    kind = "doc_id long, quality int, toxic int"
    labels = spark.createDataFrame([(7, 1, 0), (6, 1, 0), (10, 0, 0), (9, None, None), (99, 0, 0), (1, 1, 0), (1, 0, 0), (None, 1, 1)] if with_labels else [], kind)
    texts = sorted([(str(i), slow(t)) for i, t in rows])
    out = Q.quality(docs(rows), labels, keep_columns=("uid",)).collect()
    assert sorted([(str(r.doc_id), measured(r)) for r in out]) == texts
    assert all(r.uid == "clash" and (r.score is None) == (not with_labels) for r in out)
    if not with_labels:
        assert all(r.kept == (not r.base_failed) for r in out)
    assert Q.quality(docs([]), labels).count() == 0


def test_scores_are_the_calibrated_ones(spark, docs, monkeypatch):
    rng = random.Random(5)
    words = [[f"{k}{i}" for i in range(300)] for k in ("good", "bad")]
    rows = [(i, " ".join(rng.choice(words[i // 4 % 2 if rng.random() < .6 else rng.randint(0, 1)]) for _ in range(rng.randint(50, 200)))) for i in range(80)]
    labels = spark.createDataFrame([(i, 1 - i // 4 % 2, 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    seen, calibrate = [], linear.calibrate

    def spy(z, target):
        seen.append((z, calibrate(z, target)))
        return seen[-1][1]
    monkeypatch.setattr(linear, "calibrate", spy)
    out = {r.doc_id: r.score for r in Q.quality(docs(rows), labels).collect()}
    z, (scale, shift) = seen[0]
    held = sorted(out)[3::4]    # every fourth row by id is calibrated on
    assert len(z) == len(held)
    assert np.allclose([out[i] for i in held], linear.sigmoid(scale * z + shift), atol=1e-5)


def test_shares_of_rows_together_and_alone():
    texts = ["a b a", "", "one two three", "a"]
    def of(rows):
        data, off = T.buffers(pa.chunked_array([pa.array(rows, pa.string())]))
        _, spans = Q.measures(data, off)
        return list(Q.shares(Q.ngrams(data, off, spans), len(rows)))
    for f, (row, cell, share) in enumerate(of(texts)):
        for i, t in enumerate(texts):
            _, c, s = of([t])[f]
            assert np.array_equal(cell[row == i], c) and np.array_equal(share[row == i], s)
            assert not len(s) or s.sum() == pytest.approx(1, abs=1e-5)


def test_ngrams_are_of_characters():
    texts = ["za\u017c\u00f3\u0142\u0107 g\u0119\u015bl\u0105", "", "ab", "\u65e5\u672c\u8a9e\u306e\u6587", "\U0001f600\U0001f601x\u0301", "abcdefg abc"]
    data, off = T.buffers(pa.array(texts))
    _, spans = Q.measures(data, off)
    families = list(Q.ngrams(data, off, spans))
    for size, (at, cell) in zip((3, 5), families[2:]):
        cell_of = {}
        for i, t in enumerate(texts):
            grams = [t[j:j + size] for j in range(len(t) - size + 1)]
            got = cell[at[i]:at[i + 1]].tolist()
            assert len(got) == len(grams)
            for g, c in zip(grams, got):
                assert cell_of.setdefault(g, c) == c
        assert len(set(cell_of.values())) >= len(cell_of) - 1
        # a text has the same cells alone and among others
        for i, t in enumerate(texts):
            d, o = T.buffers(pa.array([t]))
            alone = list(Q.ngrams(d, o, Q.measures(d, o)[1]))[2 if size == 3 else 3][1]
            assert alone.tolist() == cell[at[i]:at[i + 1]].tolist()


def test_ngrams_of_broken_utf8():
    data, off = T.buffers(pa.array([b"\xbf\xbfabc", b"\x80", b"ab\xf0\x9f"], pa.binary()))
    char, coff = Q.characters(data, off)
    assert coff.tolist()[0] == 0 and coff[-1] == len(char) and (np.diff(coff) > 0).all()
    assert len(list(Q.ngrams(data, off, Q.measures(data, off)[1]))) == Q.FAMILIES


def test_labelled_id_that_repeats_is_one_row_of_the_sample(spark, monkeypatch):
    good, bad = "calm river stone " * 30, "buy now cheap $$$ " * 30
    rows = [(1, good + str(i % 3)) for i in range(400)] + [(2, bad)] * 300 + [(i, good if i % 2 else bad) for i in range(3, 43)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 43)], "doc_id long, quality int")
    seen = []
    fitted = linear.logistic
    monkeypatch.setattr(linear, "logistic", lambda row, col, value, n, *a, **k: (seen.append(n), fitted(row, col, value, n, *a, **k))[1])
    first = Q.fit(docs, labels)
    again = Q.fit(docs.repartition(7), labels)
    assert seen == [42, 42]
    assert all(np.allclose(a, b) for a, b in zip(first, again))
