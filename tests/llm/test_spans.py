"""Common anchors: fewer paths meet at one, and no result changes."""

import random

import pytest

from daystream.llm import spans as S
from daystream.llm import substring_dedup as W
from daystream.llm import suffix_dedup as B
from test_substring_dedup import slow as slow_words
from test_suffix_dedup import slow as slow_bytes


def corpus():
    """A third of all documents share a line, at a different place in each."""
    rng = random.Random(6)
    line = " ".join(f"licence{i}" for i in range(25))
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    rows = []
    for i in range(300):
        w = [word() for _ in range(rng.randint(20, 60))]
        if i % 3 == 0:
            w.insert(rng.randrange(len(w)), line)
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("share", [1, 200, 10 ** 9])
def test_results_do_not_depend_on_what_is_common(docs, monkeypatch, share):
    monkeypatch.setattr(S, "COMMON", share)
    rows = corpus()
    got = sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in W.substring_dedup(docs(rows), with_text=False).collect()], key=str)
    assert got == slow_words(rows)
    got = sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in B.suffix_dedup(docs(rows), with_text=False).collect()], key=str)
    assert got == slow_bytes(rows)


def test_common_anchors_hold_few_paths(docs):
    rows = S.ranked(docs(corpus()))
    hot = S.common(rows, W.word_units, 5)
    assert 0 < len(hot[0]) < 200

    def most(h):
        import numpy as np

        from daystream.llm import text as T
        seen = {}
        for r in rows.collect():
            data = np.frombuffer(r.text.encode(), np.uint8)
            off = np.array([0, len(data)])
            uoff, one, two = W.word_units(data, off)
            pre, pre2 = S.prefix(one, 0), S.prefix(two, 1)
            for lo, n, at in zip(*S.runs(pre, uoff, 13, 5, h)):
                seen.setdefault(int(S.rolled(pre, np.array([at]), np.array([at + 5]))[0]), set()).add(int(S.rolled(pre2, np.array([lo]), np.array([lo + n + 12]))[0]))
        return max(map(len, seen.values())), T
    assert most(hot)[0] < most(None)[0] / 2
