import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from daystream.llm import align_tokens as A

TABLES: list = []
FILES = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def aligner():
    return A.Aligner(*FILES)


def whole(text, x):
    """Tokens of the whole text, their bytes one after another, groups by offsets counted in bytes."""
    if not text:
        return None
    raw = b" " + text.encode()
    tables = [[t.of(np.array([i])) for i in range(len(t.size))] for t in (x.a_bytes, x.b_bytes)] if not TABLES else TABLES
    TABLES[:] = tables
    a, b = x.a.encode(" " + text, add_special_tokens=False).ids, x.b.encode(text)
    if b"".join(tables[0][i] for i in a) != raw or b"".join(tables[1][i] for i in b) != raw:
        return None
    owner, cut = {}, [set(), set()]
    for side, ids, table in ((0, a, tables[0]), (1, b, tables[1])):
        at = 0
        for i in ids:
            at += len(table[i])
            cut[side].add(at)
    both, groups = sorted(cut[0] & cut[1]), []
    for side, ids, table in ((0, a, tables[0]), (1, b, tables[1])):
        at, k = 0, 0
        for i in ids:
            owner.setdefault((side, k), []).append(i)
            at += len(table[i])
            k += at == both[k]
    for k in range(len(both)):
        groups.append((owner[0, k], owner[1, k]))
    return a, b, groups


def slow(rows, x):
    each = [whole(t, x) for _, t in rows]
    held = Counter()
    for w in each:
        held.update({(u, v) for g in w[2] for u in g[0] for v in g[1]} if w else ())
    top = defaultdict(int)
    for (u, _), n in held.items():
        top[u] = max(top[u], n)
    out = []
    for (i, _), w in zip(rows, each):
        if not w:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(u, v) for g in w[2] for u in g[0] for v in g[1]]
        shown = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in w[2])
        out.append((i, len(w[0]), len(w[1]), len(w[2]), len(links), sum(held[p] == top[p[0]] for p in links),
                    sum(held[p] for p in links), hashlib.sha256(shown.encode()).hexdigest()))
    return sorted(out, key=str)


PARTS = ["the", "Cat's", "naïve", "漢字かな", "🙂👩‍👩‍👧", "ﬁ", "é", "x" * 70, "123456", "==>", "<s>", "</s>", "<|endoftext|>", "<unk>", "<0x41>", "İ", "ก็", "́",
         "don't", "'ll", "a b", "a b", "\x1c", "\x85z", "​", "q\tq", "q\r\nq", "end.", "\x00", "﻿", "𐍈", "é́"]
GAPS = [" ", " ", " ", " ", "\n", "\n\n", "  ", " \n", "\n ", "\t", "\r\n", "   \n\n  ", "　", "", "\n\t\n"]


def make(rng, n):
    return rng.choice(["", " ", "\n", "\n\n ", "\t"]) + "".join(rng.choice(PARTS) + rng.choice(GAPS) for _ in range(n))


def shown(x):
    """The groups of every document, from those of its stretches."""
    ends = x.stretch_end.tolist()
    return [";".join(x.groups[k] for k in x.stretch[i:j]) for i, j in zip([0, *ends], ends)]


def test_seams_do_not_change_tokens(aligner):
    """The stretches between seams give the tokens, groups and links of the whole text."""
    rng = random.Random(8)
    texts = [make(rng, rng.randint(1, 25)) for _ in range(3000)]
    assert aligner.seams
    x = aligner([" " + t for t in texts])
    n_a, n_b, _, n_links = (A.per_document(x, f).tolist() for f in x.figures)
    for k, (t, found) in enumerate(zip(texts, shown(x))):
        w = whole(t, aligner)
        assert found == (";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in w[2]) if w else "")
        if w:
            assert (n_a[k], n_b[k], n_links[k]) == (len(w[0]), len(w[1]), sum(len(g[0]) * len(g[1]) for g in w[2]))


def test_two_ways_to_split():
    rng = random.Random(10)
    texts = [" " + make(rng, rng.randint(0, 6)) for _ in range(2000)] + [" a b\nc", " a\tb c", " \0 a b", " é ü\nö", " a\u3000b c", " a \x1cb"]
    assert all(A.split_at_seams(t) == A.SEAM.split(t) for t in texts)


def test_spans_refined_by_bytes():
    """é in two tokens, then a in one: both tokens of é have its whole span; or three bytes whose span is the last one's."""
    ends = lambda spans, at: A.byte_ends(np.arange(3), *np.array(spans).T, np.array(at), np.ones(3, int)).tolist()
    assert ends([(0, 1), (0, 1), (1, 2)], [0, 2, 3]) == [1, 2, 3]
    assert ends([(0, 0), (0, 0), (0, 1)], [0, 3]) == [1, 2, 3]


def test_wide_groups(aligner, monkeypatch):
    """Groups too wide to write out link by link give the same pairs."""
    texts = [" " + "漢字かな🙂" * 30, " " + "=-" * 200 + "é" * 50, " a b"] * 2
    a = aligner(texts)
    monkeypatch.setattr(A, "WIDE", 1)
    b = aligner(texts)
    for x, y in zip(a, b):
        assert all(map(np.array_equal, x, y)) if isinstance(x, list) and not isinstance(x[0], str) else np.array_equal(x, y)


@pytest.mark.parametrize("block", [200, 1 << 22])
def test_same_as_by_hand(docs, aligner, block):
    rng = random.Random(9)
    rows = [(i, make(rng, rng.randint(1, 40))) for i in range(150)]
    rows += [(5, rows[5][1])] * 3 + [(None, "no id"), (900, None), (901, ""), (902, "with ▁ in it"), (903, " "), (904, "\n"), (905, "▁"),
             (906, "z" * 3000), (907, "漢字" * 500), (908, "ab ▁ cd")]
    df = docs(rows).repartition(3).withColumn("block", F.lit("clash")).withColumn("n_docs", F.lit(1))
    assert sorted(map(tuple, A.align(df, *FILES, block=block).collect()), key=str) == slow(rows, aligner)


def test_without_seams(aligner):
    """A tokenizer that may join across a seam gets whole texts."""
    texts = [" a b\nc", " naïve  漢", " \n", "", " with ▁ in it"]
    whole_only = A.Aligner(*FILES)
    whole_only.seams = False
    assert shown(whole_only(texts)) == shown(aligner(texts))


def test_empty(docs):
    assert A.align(docs([(1, "x")]).limit(0), *FILES).count() == 0
    assert A.align(docs([(1, None), (2, "")]), *FILES).count() == 2


def test_provided_table(spark, aligner):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert sorted(map(tuple, A.op13_align(spark, "/root/testdata/sf0.001").collect()), key=str) == slow(rows, aligner)


def test_stretches_of_earlier_blocks_are_not_encoded_again(monkeypatch):
    x, asked = A.Aligner(*FILES), []
    tokens = x.tokens
    monkeypatch.setattr(x, "tokens", lambda text: asked.append(text) or tokens(text))
    one = x([" the cat sat", " on the mat"])
    asked.clear()
    two = x([" the mat sat here"])
    assert "".join(asked) == " here"
    assert shown(one)[1] == shown(A.Aligner(*FILES)([" on the mat"]))[0] and shown(two) == shown(A.Aligner(*FILES)([" the mat sat here"]))


def test_remembered_stretches_are_bounded_and_change_nothing():
    rng, x = random.Random(5), A.Aligner(*FILES)
    x.known.most = 20
    for _ in range(12):
        texts = [" " + make(rng, rng.randrange(1, 40)) for _ in range(4)] + [" a▁b the", " the " + "z" * 500 + "q▁" * 50]
        got, fresh = x(texts), A.Aligner(*FILES)(texts)
        assert shown(got) == shown(fresh)
        assert all((A.per_document(got, f) == A.per_document(fresh, g)).all() for f, g in zip(got.figures, fresh.figures))
        assert dict(zip(got.id_pair.tolist(), A.documents_with(got).tolist())) == dict(zip(fresh.id_pair.tolist(), A.documents_with(fresh).tolist()))
        assert len(x.known.place) == len(x.known.size) <= 20 and not any("▁" in s or len(s) > 400 for s in x.known.place)
