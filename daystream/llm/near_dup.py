"""Near-duplicate documents by ProbMinHash, banding and exact verification."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystream.llm import spans as S
from daystream.llm import text as T
from daystream.llm.store import components, stage

SHINGLE, THRESHOLD = 5, 0.8
#: Bands of rows; registers are the next prime, so that steps of any size visit all of them.
BANDS, ROWS, REGISTERS = 20, 5, 101
#: Members a side of one task's comparison.
TILE = 512


def shingles(data, off, size: int):
    """(row, hash, count) of the distinct word shingles of each text, by row and hash.

    A text of fewer than ``size`` words has one shingle, all its words.
    """
    start, end, row = T.words(data, off)
    n = T.row_counts(row, len(off) - 1)
    uoff = np.r_[0, np.cumsum(n)]
    pre = S.prefix(T.span_hash(data, start, end, 0), 1)
    per = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    lo = T.ranges(uoff[:-1], per)
    r = np.repeat(np.arange(len(n)), per)
    h = S.rolled(pre, lo, np.minimum(lo + size, uoff[r + 1]))
    o = np.lexsort((h, r))
    h, r = h[o], r[o]
    new = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (r[1:] != r[:-1])]) if len(h) else np.zeros(0, np.int64)
    return r[new], h[new], np.diff(np.r_[new, len(h)])


def signatures(row, h, count, n_rows: int, registers: int = REGISTERS) -> np.ndarray:
    """ProbMinHash registers (n_rows x registers), all ones where a row has no shingle.

    Each shingle of a text is a Poisson process whose rate is its share of the
    text's weight; an arrival falls into a register that the shingle has not
    met yet, and a register keeps its earliest shingle. Two texts agree in a
    register with the probability that is their probability Jaccard. Arrivals
    of a shingle come in order, so it stops as soon as the next one is later
    than what every register of the text holds.
    """
    weight = np.bincount(row, count, n_rows)
    share = count / weight[row]
    best = np.full(n_rows * registers, np.inf)
    sig = np.full(n_rows * registers, ~np.uint64(0))
    at = (T.mix(h ^ np.uint64(0x51ED270B8A4D1C35)) % np.uint64(registers)).astype(np.int64)
    step = 1 + (T.mix(h ^ np.uint64(0x8CB92BA72F3D8DD7)) % np.uint64(registers - 1)).astype(np.int64)
    time = np.zeros(len(h))
    salted = h.copy()
    for i in range(registers):
        salted = T.mix(salted + np.uint64(0x9E3779B97F4A7C15))
        u = ((salted >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
        time = time - np.log(u) / (share * (registers - i))
        slot = row * registers + at
        better = np.flatnonzero(time < best[slot])
        better = better[np.lexsort((h[better], time[better]))[::-1]]
        best[slot[better]] = time[better]
        sig[slot[better]] = h[better]
        last = best.reshape(n_rows, registers).max(1)
        go = np.flatnonzero(time < last[row])
        if not len(go):
            break
        row, h, share, at, step, time, salted = (x[go] for x in (row, h, share, at, step, time, salted))
        at = (at + step) % registers
    return sig.reshape(n_rows, registers)


def similarity(h1, c1, h2, c2) -> float:
    """Probability Jaccard of two weighted sets, hashes ascending.

    The sum over common i of 1 / sum_j max(a_j / a_i, b_j / b_i); ordered by
    a / b, the inner sum is a suffix sum of a and a prefix sum of b.
    """
    if not len(h1) or not len(h2):
        return 0.0
    at = np.searchsorted(h2, h1)
    at[at == len(h2)] = 0
    both = h2[at] == h1
    if not both.any():
        return 0.0
    a, b = c1[both] / c1.sum(), c2[at[both]] / c2.sum()
    only_a = c1[~both].sum() / c1.sum()
    only_b = (c2.sum() - c2[at[both]].sum()) / c2.sum()
    o = np.argsort(a / b, kind="stable")
    a, b = a[o], b[o]
    r = a / b
    sum_a = only_a + np.cumsum(a[::-1])[::-1]
    sum_b = only_b + np.r_[0.0, np.cumsum(b)[:-1]]
    # of equal ratios either side gives the same value, so each may take its own place
    return float((1.0 / (sum_a / a + sum_b / b)).sum()) if len(r) else 0.0


def _signed(rows: DataFrame, size: int, bands: int, per: int) -> DataFrame:
    def run(batches):
        for b in batches:
            for part in T.pieces(pa.Table.from_batches([b]), "text"):
                data, off = T.buffers(part.column("text"))
                n = part.num_rows
                r, h, c = shingles(data, off, size)
                sig = signatures(r, h, c, n)
                has = np.bincount(r, minlength=n)
                # names the weighted set: sums of two independent scramblings of its members
                a, z = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
                cu = c.astype(np.uint64)
                np.add.at(a, r, T.mix(h + cu * np.uint64(0xA0761D6478BD642F)))
                np.add.at(z, r, T.mix(T.mix(h ^ np.uint64(0xE7037ED1A0B428DB)) * (cu + cu + np.uint64(1))))
                keys = np.zeros((n, bands), np.uint64)
                for j in range(bands):
                    k = np.full(n, j + 1, np.uint64)
                    for x in range(per):
                        k = T.mix(k * np.uint64(0x9FB21C651E98DF25) + sig[:, j * per + x])
                    keys[:, j] = k
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bands), pa.array(keys.view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(x).combine_chunks().cast(pa.int64()) if not isinstance(part.column(x).combine_chunks(), pa.ChunkedArray)
                       else pa.concat_arrays(part.column(x).chunks) for x in ("uid", "rank", "doc_id")),
                     pa.array(has.astype(np.int64)), pa.array(a.view(np.int64)), pa.array(z.view(np.int64)), lists],
                    ["uid", "rank", "doc_id", "n_shingles", "set_a", "set_b", "bands"])

    return rows.select("uid", "rank", "doc_id", "text").mapInArrow(
        run, "uid long, rank long, doc_id long, n_shingles long, set_a long, set_b long, bands array<long>")


def _verified(pairs: DataFrame, rows: DataFrame, size: int, threshold: float) -> DataFrame:
    """The pairs (a, b: uid) whose texts reach the threshold."""
    def run(batches):
        for b in batches:
            keep = np.zeros(b.num_rows, bool)
            t = pa.Table.from_batches([b])
            at = 0
            for part in T.pieces(t, "ta", 1 << 20):
                sets = []
                for name in ("ta", "tb"):
                    data, off = T.buffers(part.column(name))
                    r, h, c = shingles(data, off, size)
                    sets.append((h, c, np.searchsorted(r, np.arange(part.num_rows + 1))))
                (ha, ca, oa), (hb, cb, ob) = sets
                for i in range(part.num_rows):
                    keep[at + i] = similarity(ha[oa[i]:oa[i + 1]], ca[oa[i]:oa[i + 1]],
                                              hb[ob[i]:ob[i + 1]], cb[ob[i]:ob[i + 1]]) >= threshold - 1e-12
                at += part.num_rows
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["src", "dst"]).filter(pa.array(keep))

    one = rows.select("uid", "text").dropDuplicates(["uid"])
    joined = (pairs.join(one.select(F.col("uid").alias("a"), F.col("text").alias("ta")), "a")
              .join(one.select(F.col("uid").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb"))
    return joined.mapInArrow(run, "src long, dst long")


def _across(rest: DataFrame, rows: DataFrame, size: int, threshold: float) -> DataFrame:
    """Links between the components (c) that meet in a group (key), exactly, in tiles."""
    def run(key, t):
        slot, uid, c = (t.column(x).to_numpy() for x in ("slot", "uid", "c"))
        data, off = T.buffers(t.column("text"))
        r, h, n = shingles(data, off, size)
        p = n / np.bincount(r, n, t.num_rows)[r]
        cut = np.searchsorted(r, np.arange(t.num_rows + 1))
        a, b = key[1].as_py(), key[2].as_py()
        # outer loop over the members outside the tile's largest component
        who, many = np.unique(c, return_counts=True)
        odd = np.flatnonzero(c != who[np.argmax(many)])
        src, dst = [], []
        for i in odd:
            mine, share = h[cut[i]:cut[i + 1]], p[cut[i]:cut[i + 1]]
            at = np.searchsorted(mine, h)
            at[at == len(mine)] = 0
            both = mine[at] == h
            # a text can only reach the threshold if the shares in common do
            most = np.bincount(r[both], np.minimum(share[at[both]], p[both]), t.num_rows)
            for j in np.flatnonzero((most >= threshold - 1e-9) & (c != c[i]) & ((slot == b) if slot[i] == a else (slot == a) | (a == b))):
                if similarity(mine, n[cut[i]:cut[i + 1]], h[cut[j]:cut[j + 1]], n[cut[j]:cut[j + 1]]) >= threshold - 1e-12:
                    src.append(uid[i])
                    dst.append(uid[j])
        # a pair that meets in several bands is found in each; one link per pair and band is little beside the texts
        return pa.table([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], ["src", "dst"])

    one = rows.select("uid", "text").dropDuplicates(["uid"])
    # each text once to every group it is unsettled in: first the text, then the groups
    tiles = (rest.withColumn("slot", F.pmod(F.xxhash64("uid", "key"), F.col("split")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("split") - 1)))
             .select("key", F.least("slot", "other").alias("a"), F.greatest("slot", "other").alias("b"), "slot", "uid", "c"))
    return tiles.join(one, "uid").groupBy("key", "a", "b").applyInArrow(run, "src long, dst long")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD,
                    bands: int = BANDS, per: int = ROWS) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text): uid, doc_id, n_shingles, class_id, component_id, kept.

    Documents with the same weighted word shingles are one class (``class_id``:
    its smallest doc_id). Classes are signed by ProbMinHash; classes that agree
    in a band are candidates, and those whose probability Jaccard, computed
    from the texts, is at least ``threshold`` are linked. ``component_id`` is
    the smallest doc_id among documents connected by links; ``kept`` marks the
    document that has it.

    In a band's group every member is first compared with two pivots, which
    settles a group of true copies in a few comparisons a member. Members still
    in different components after that are compared with one another inside
    tasks of at most ``TILE`` members a side, which return links and no pairs, so
    no link between components is lost. With 20 bands of 5 a pair at the threshold is a candidate
    with probability 0.9996.

    Null and empty texts have no shingles and stay alone; a text shorter than a
    shingle is one shingle. Null doc_ids come after all others. Rows equal in
    id and text are one document here. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = S.ranked(docs)
    signed = stage(_signed(rows, size, bands, per), "signed")
    classes = signed.filter("n_shingles > 0").groupBy("set_a", "set_b").agg(
        F.min(F.struct("rank", "uid", "bands")).alias("r"))
    reps = classes.select("set_a", "set_b", F.col("r.rank").alias("rank"), F.col("r.uid").alias("uid"), F.col("r.bands").alias("bands"))
    reps = stage(reps, "classes")
    keyed = reps.select("uid", "rank", F.explode("bands").alias("key"))
    # two pivots a group: the first document, and one at random, another in each band
    groups = keyed.groupBy("key").agg(F.min(F.struct("rank", "uid")).alias("p"), F.min(F.struct(F.xxhash64("uid", "key"), "uid")).alias("q"),
                                      F.count("*").alias("n")).filter("n > 1")
    met = stage(keyed.join(groups.select("key", F.array("p.uid", "q.uid").alias("pivots")), "key"), "met")
    pairs = met.select("uid", F.explode("pivots").alias("pivot")).filter("uid <> pivot").select(
        F.least("uid", "pivot").alias("a"), F.greatest("uid", "pivot").alias("b")).distinct()
    links = stage(_verified(pairs, rows, size, threshold), "links")
    comp = stage(components(spark, links), "components")

    # members that share a band but not a component
    placed = met.join(comp, met.uid == comp.id, "left").select("key", "uid", F.coalesce("component_id", "uid").alias("c"))
    apart = placed.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("n")).filter("lo < hi")
    rest = stage(placed.join(apart.select("key", F.ceil(F.col("n") / TILE).cast("int").alias("split")), "key"), "apart")
    found = stage(_across(rest, rows, size, threshold), "more-links")
    comp = stage(components(spark, links.unionByName(found)), "components")

    named = reps.select("set_a", "set_b", F.col("rank").alias("class_rank"), F.col("uid").alias("class_uid"))
    named = named.join(comp, named.class_uid == comp.id, "left").withColumn("c", F.coalesce("component_id", "class_uid"))
    low = named.groupBy("c").agg(F.min(F.struct("class_rank", "class_uid")).alias("first"))
    named = named.join(low, "c").select("set_a", "set_b", "class_rank", F.col("first.class_rank").alias("first_rank"), F.col("first.class_uid").alias("first_uid"))
    out = signed.drop("bands").join(named, ["set_a", "set_b"], "left")
    return out.select(
        "uid", "doc_id", "n_shingles",
        _doc_id(F.when(F.col("n_shingles") > 0, F.col("class_rank")).otherwise(F.col("rank"))).alias("class_id"),
        _doc_id(F.when(F.col("n_shingles") > 0, F.col("first_rank")).otherwise(F.col("rank"))).alias("component_id"),
        F.when(F.col("n_shingles") > 0, F.col("uid") == F.col("first_uid")).otherwise(F.lit(True)).alias("kept"))


def _doc_id(rank):
    return F.when(rank < S.LAST, rank)


def op6_near_duplicates(spark, sf_dir: str) -> DataFrame:
    from daystream.session import read_table
    return near_duplicates(read_table(spark, sf_dir, "documents")).drop("uid")
