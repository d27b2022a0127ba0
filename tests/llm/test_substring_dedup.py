import hashlib
import random

from daystream.llm import substring_dedup as D


def slow(rows, width=13):
    order = lambda d: (d is None, d)
    first, out = {}, []
    texts = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in texts:
        for i in range(len(w) - width + 1):
            k = tuple(w[i:i + width])
            first[k] = min(first.get(k, order(d)), order(d))
    for d, w in texts:
        gone = set()
        for i in range(len(w) - width + 1):
            if first[tuple(w[i:i + width])] < order(d):
                gone.update(range(i, i + width))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(df):
    return sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in D.substring_dedup(df, with_text=False).collect()], key=str)


def test_random_passages(docs):
    rng = random.Random(2)
    vocabulary = "a b c dd ee".split()
    for seed in range(3):
        rng.seed(seed)
        shared = [[rng.choice(vocabulary) for _ in range(rng.randint(10, 60))] for _ in range(6)]
        rows = []
        for i in range(60):
            w = []
            for _ in range(rng.randint(0, 5)):
                p = rng.choice(shared)
                s = rng.randint(0, len(p) // 2)
                w += p[s:rng.randint(s, len(p))] if rng.random() < .7 else [f"u{rng.randint(0, 999)}" for _ in range(rng.randint(0, 20))]
            rows.append((rng.randint(0, 10 ** 12), rng.choice([" ", "\n", " \t"]).join(w)))
        assert run(docs(rows)) == slow(rows)


def test_odd_rows(docs):
    p = " ".join(f"w{i}" for i in range(20))
    rows = [(5, p), (2, "x " + p + " y"), (None, p), (7, None), (8, ""), (9, " ".join(["z"] * 3000)), (10, " ".join(["z"] * 14)),
            (11, p), (11, p), (2, "other " + p), (12, "  "), (13, " ".join(f"w{i}" for i in range(12)))]
    assert run(docs(rows)) == slow(rows)
    assert run(docs([])) == []


def test_text_is_what_the_digest_says(docs):
    p = " ".join(f"wé{i}" for i in range(30))
    for r in D.substring_dedup(docs([(1, p), (2, "vorn " + p + " hinten")])).collect():
        assert hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256
        assert r.doc_id == 1 or r.text == "vorn hinten"
