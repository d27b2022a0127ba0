"""Toxicity by weak supervision: voters, a generative label model, a linear classifier."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystream.llm import linear
from daystream.llm import text as T
from daystream.llm.quality import labelled
from daystream.llm.store import stage

#: Documents of each label that voters are found on, voters, and classifier features, at most.
SAMPLE, VOTERS, FEATURES = 3000, 512, 2048
THRESHOLD = 0.3
#: What a pattern must show on the sample: how much likelier among toxic documents, and
#: the share of patterns like it and as clear that chance would give at most.
LIFT, FALSE = 30, 0.05
#: Bytes of a word's start that make a pattern of their own.
PREFIXES = (3, 4, 5, 6, 8)
_BETWEEN = np.ones(256, bool)
_BETWEEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def patterns(data, off):
    """(row, hash) of every word, word-start and word-pair pattern of each text, A-Z lower-cased.

    A word here is a run of letters, digits and bytes from 128; a pair is two
    words that follow one another. The top three bits of a hash name its kind: 0
    for words, 1 to 5 for word starts by length, 6 for pairs.
    """
    start, end, row = T.words(data, off, _BETWEEN)
    low = LOWER[data]
    if not len(start):
        return row, np.zeros(0, np.uint64)
    n = len(low)
    p, q = T._powers(n + 1, 0)
    s = np.zeros(n + 1, np.uint64)
    np.cumsum(T.BYTE_VALUE[0][low] * p[:n], out=s[1:])
    base, inv = s[start], q[start]
    word = T.mix((s[end] - base) * inv)
    rows, out = [row], [_of_kind(word, 0)]
    for i, k in enumerate(PREFIXES):
        has = np.flatnonzero(end - start > k)
        rows.append(row[has])
        out.append(_of_kind(T.mix((s[start[has] + k] - base[has]) * inv[has] + np.uint64(k)), i + 1))
    has = np.flatnonzero(row[1:] == row[:-1])
    rows.append(row[has])
    out.append(_of_kind(T.mix(word[has] * np.uint64(0x9FB21C651E98DF25) + word[has + 1]), len(PREFIXES) + 1))
    return np.concatenate(rows), np.concatenate(out)


def _of_kind(h, kind: int):
    return (h & np.uint64((1 << 61) - 1)) | np.uint64(kind << 61)


def _hits(data, off, known: np.ndarray, sieve: np.ndarray):
    """(row, index in ``known``) of the known patterns that occur in each text, once each."""
    row, h = patterns(data, off)
    some = np.flatnonzero(sieve[(h & np.uint64(len(sieve) - 1)).astype(np.int64)])
    row, h = row[some], h[some]
    at = np.searchsorted(known, h)
    at[at == len(known)] = 0
    ok = known[at] == h if len(known) else np.zeros(0, bool)
    both = np.unique(row[ok] * np.int64(max(1, len(known))) + at[ok])
    return both // max(1, len(known)), both % max(1, len(known))


def _sieve(known: np.ndarray) -> np.ndarray:
    s = np.zeros(1 << 20, bool)
    s[(known & np.uint64(len(s) - 1)).astype(np.int64)] = True
    return s


def candidates(sample: DataFrame, most: int) -> DataFrame:
    """Patterns (hash, toxic, clean document counts) that lean to toxic documents, the clearest first.

    Patterns of one kind that occur in equally many documents (in powers of two
    above 16) are a family. By chance a pattern reaches a log-likelihood ratio G
    with probability exp(-G / 2) at most, so a family of N has N exp(-G / 2) such
    patterns by chance; it is taken from the smallest G on where these are at
    most ``FALSE`` of those it has. Words met in three toxic documents and
    no clean one are found this way if there are many of them, and left alone if they are
    no more than chance gives.
    """
    def run(batches):
        for b in batches:
            for part in T.pieces(pa.Table.from_batches([b]), "text", 2 << 20):
                data, off = T.buffers(part.column("text"))
                target = part.column("target").to_numpy()
                row, h = patterns(data, off)
                o = np.lexsort((row, h))
                h, row = h[o], row[o]
                once = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])]) if len(h) else np.zeros(0, np.int64)
                h, toxic = h[once], target[row[once]]
                cut = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
                if len(cut):
                    t = np.add.reduceat(toxic, cut).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(h[cut].view(np.int64)), pa.array(t), pa.array(np.diff(np.r_[cut, len(h)]) - t)],
                                                     ["hash", "toxic", "clean"])

    n = sample.agg(F.sum("target").alias("t"), F.count("*").alias("n")).first()
    toxic, clean = int(n.t or 0), int(n.n or 0) - int(n.t or 0)
    found = sample.mapInArrow(run, "hash long, toxic long, clean long").groupBy("hash").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    share_t, share_c = (F.col("toxic") + 0.5) / (toxic + 1), (F.col("clean") + 0.5) / (clean + 1)
    p = toxic / max(1, toxic + clean)
    part = lambda c, q: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / ((F.col("toxic") + F.col("clean")) * q))).otherwise(0.0)
    # G: the log-likelihood ratio against chance
    seen = F.col("toxic") + F.col("clean")
    found = found.withColumn("g", 2 * (part("toxic", p) + part("clean", 1 - p))).withColumn(
        "family", F.shiftrightunsigned("hash", 61) * 64 + F.when(seen <= 16, seen).otherwise(13 + F.floor(F.log2(seen))))
    found = stage(found.withColumn("leans", (F.col("toxic") >= 3) & (share_t > LIFT * share_c)), "toxicity-patterns")
    # at most families times bins rows: G in halves up to 100
    bins = found.groupBy("family", F.when(F.col("leans"), F.least(F.floor(2 * F.col("g")), F.lit(200))).alias("bin")).count().collect()
    from_g = {}
    for family in {r["family"] for r in bins}:
        size = sum(r["count"] for r in bins if r["family"] == family)
        tail = 0
        for b, k in sorted(((r["bin"], r["count"]) for r in bins if r["family"] == family and r["bin"] is not None), reverse=True):
            tail += k
            if size * np.exp(-b / 4) <= FALSE * tail:
                from_g[family] = b / 2
    if not from_g:
        return found.select("hash", "toxic", "clean").limit(0)
    least = F.create_map(*[F.lit(x) for f, g in sorted(from_g.items()) for x in (int(f), float(g))])
    found = found.filter("leans").filter(F.col("g") >= least[F.col("family").cast("int")])
    return found.withColumn("gain", F.col("toxic") * F.log(share_t / share_c)).orderBy(F.desc("gain"), "hash").limit(most)


def voters_of(hits: list, target: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """The patterns that vote, at most ``most``, of ``order`` (the clearest first).

    A pattern that fires, where no earlier voter does, mostly in clean
    documents has its lean from a clearer one that it comes with (a word of a
    toxic pair) and doesn't vote.
    """
    rows_of = [[] for _ in order]
    for i, h in enumerate(hits):
        for j in h:
            rows_of[j].append(i)
    covered, out = np.zeros(len(hits), bool), []
    for j in order:
        rows = np.array(rows_of[j], np.int64)
        left = rows[~covered[rows]]
        if len(left) and 2 * (target[left] == 1).sum() < len(left):
            continue
        out.append(j)
        covered[rows] = True
        if len(out) == most:
            break
    return np.array(out, np.int64)


def label_model(votes: np.ndarray, prior: float, start=None, rounds: int = 40):
    """Posterior of label 1 for each row of 0/1 ``votes``, and each voter's (rate on 1, rate on 0, share of weight).

    A generative model of the votes alone: given the label, voter j fires with
    its own rate; rates, the voters' accuracies, come from EM, started by
    ``start`` (a first guess of each label) or else by any vote at all. A voter that does not fire abstains; one more voter fires for
    label 0 where all others abstain. Voters that fire together beyond what the label explains are
    correlated: after the first rounds, each voter's evidence is divided by the
    sum of its squared residual correlations with all voters, so that a hundred
    spellings of one pattern weigh as one.
    """
    fired = votes.sum(1)
    votes = np.hstack([votes, (fired == 0)[:, None].astype(float)])
    n, k = votes.shape
    post = np.clip(np.where(fired > 0, 0.9, 0.05 * prior) if start is None else 0.02 + 0.96 * start, 1e-6, 1 - 1e-6)
    share = np.ones(k)
    for i in range(rounds):
        one, zero = post.sum(), (1 - post).sum()
        a = np.clip((votes.T @ post + 0.1) / (one + 0.2), 1e-4, 1 - 1e-4)
        b = np.clip((votes.T @ (1 - post) + 0.01) / (zero + 0.2), 1e-5, 1 - 1e-4)
        if i in (5, 15):
            left = votes - np.outer(post, a) - np.outer(1 - post, b)
            cov = left.T @ left / n
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
            corr = np.clip(cov / np.outer(sd, sd), -1, 1)
            np.fill_diagonal(corr, 1.0)
            share = 1.0 / (np.maximum(corr, 0) ** 2).sum(1)
        z = np.log(prior / (1 - prior)) + votes @ (share * np.log(a / b))
        new = np.clip(linear.sigmoid(z), 1e-6, 1 - 1e-6)
        if np.abs(new - post).max() < 1e-6 and i > 16:
            break
        post = new
    return post, np.stack([a, b, share], 1)


def fit(docs: DataFrame, labels: DataFrame, allowed=None, sample: int = SAMPLE, voters: int = VOTERS, features: int = FEATURES):
    """(sorted pattern hashes, weights, bias) or None if the labels have not both kinds.

    Labels serve to find the voters and the prior; the label model sees only
    votes, and what the classifier learns from are its posteriors. Both samples are bounded and
    chosen by hash; only counts and hits of found patterns reach the driver.
    """
    toxic = labelled(docs, labels.filter("toxic = 1"), "toxic", sample, allowed)
    clean = labelled(docs, labels.filter("toxic = 0"), "toxic", sample, allowed)
    seen = labels.filter(allowed) if allowed is not None else labels
    share = seen.filter("toxic in (0, 1)").agg(F.avg("toxic")).first()[0]
    if share is None or share in (0.0, 1.0):
        return None
    prior = float(share)
    # a doc_id met again with other texts counts once, so the bound holds for rows
    rows = stage(toxic.unionByName(clean).groupBy("doc_id", "target").agg(F.min("text").alias("text")), "toxicity-sample")
    top = candidates(rows, features).collect()   # at most ``features`` rows
    if not top:
        return None
    hashes = np.array([r["hash"] for r in top], np.int64).view(np.uint64)
    rank = np.argsort(hashes)
    known = hashes[rank]
    sieve = _sieve(known)

    def run(batches):
        for b in batches:
            for part in T.pieces(pa.Table.from_batches([b]), "text", 2 << 20):
                data, off = T.buffers(part.column("text"))
                row, at = _hits(data, off, known, sieve)
                cut = np.searchsorted(row, np.arange(part.num_rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays(part.column("doc_id").chunks), pa.concat_arrays(part.column("target").chunks),
                     pa.array([at[cut[i]:cut[i + 1]].astype("<i2").tobytes() for i in range(part.num_rows)], pa.binary())], ["doc_id", "target", "hits"])

    got = rows.select("doc_id", "target", "text").mapInArrow(run, "doc_id long, target int, hits binary").toArrow().sort_by("doc_id")
    target = got["target"].to_numpy()
    hits = [np.frombuffer(x, "<i2").astype(np.int64) for x in got["hits"].to_pylist()]
    row = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
    col = np.concatenate(hits)
    place = np.full(len(known), -1)
    chosen = voters_of(hits, target, np.argsort(rank), voters)
    place[chosen] = np.arange(len(chosen))
    votes = np.zeros((len(hits), len(chosen)))
    votes[row[place[col] >= 0], place[col][place[col] >= 0]] = 1.0
    post, _ = label_model(votes, float(np.clip((target == 1).mean(), 0.01, 0.99)))
    # back from the sample's mix of labels to the corpus's
    weight = np.where(target == 1, prior / max((target == 1).mean(), 1e-9), (1 - prior) / max((target == 0).mean(), 1e-9))
    w, b = linear.logistic(row, col, np.ones(len(row)), len(post), len(known), post, weight, l2=1e-5, rounds=300)
    return known, w, b


def toxicity(docs: DataFrame, labels: DataFrame, allowed=None, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, score, predicted) for every row of ``docs`` (doc_id, text).

    Voters are lexicon words, word starts and word pairs found on a bounded sample
    of labelled rows (``allowed`` says which labels may be used). A generative
    label model of their votes estimates each voter's accuracy and the
    correlations among them; its posteriors train a logistic regression on the
    patterns that occur in a whole text. score is its probability, predicted 1
    from ``threshold`` on.

    Only the text is an input of a score. Null and empty texts get the score of
    a text without any pattern. Without usable labels of both kinds the score
    is 0. Contradicting, null or other labels are not used. Repeated rows and
    null ids are scored as rows of their own; other columns are not read. An
    empty table gives an empty result.
    """
    model = fit(docs, labels, allowed, sample)

    def run(batches):
        sieve = _sieve(model[0]) if model else None
        for b in batches:
            for part in T.pieces(pa.Table.from_batches([b]), "text"):
                p = np.zeros(part.num_rows)
                if model:
                    data, off = T.buffers(part.column("text"))
                    row, at = _hits(data, off, model[0], sieve)
                    p = linear.sigmoid(np.bincount(row, model[1][at], part.num_rows) + model[2])
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(part.column("doc_id").chunks), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                                                 ["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, score double, predicted int")


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    from daystream.session import read_table
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    out = toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), ~held)
    return out.select("doc_id", held.alias("held_out"), "score", "predicted")
