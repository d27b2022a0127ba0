"""Near-duplicate embeddings: sign hashing, exact cosine, connected components."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystream.llm.store import components, stage

THRESHOLD, MISS, TILE = 0.98, 1e-4, 2048


def planes(dim: int, tables: int, bits: int, seed: int = 11) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, tables * bits))


def shape(largest: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """(bits, tables): about 32 unrelated vectors a bucket of the largest label, and a
    pair at the threshold missed by all tables with probability ``miss`` at most."""
    bits = min(24, max(4, math.ceil(math.log2(max(2, largest / 32)))))
    p = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log(1 - p)))


def _matrix(column) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), "<f8") for c in column.chunks for x in c]


def _local_components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest member of each member's component, for the pairs of one tile."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def embedding_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, miss: float = MISS, tile: int = TILE) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Two vectors are linked if their labels are equal and not null and their
    cosine, in double precision, is at least ``threshold``. n_links counts the
    other vectors linked directly, component_id is the smallest vec_id
    reachable by links, kept says whether that is the row's own.

    Equal vectors of a label are one node with a multiplicity. Each node gets
    the signs of its products with random hyperplanes, ``bits`` of them in each
    of several tables (:func:`shape`), and is compared with the nodes that
    share a table's bits: whole buckets by matrix products, in tiles of at most
    ``tile`` nodes a side, so a hot bucket becomes many tasks. A pair that
    meets in several tables is counted in the first. Tiles give counts and, for
    the components, one edge a node; no pair leaves a task.

    Vectors that are null, empty, zero, or hold null or non-finite components,
    and vectors with a null label, link with nothing, not even an equal one;
    vectors of different lengths don't link. Rows that share a vec_id are
    vectors of their own; a component's null ids are passed over, and a vector
    whose component has no id has a null component and is kept. An empty table
    gives an empty result. Other columns are not read.
    """
    spark = vectors.sparkSession
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), "label")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    v = v.withColumn("ok", F.coalesce(F.col("label").isNotNull() & ~bad & some, F.lit(False)))
    # +0.0 makes negative zeros equal to zeros
    v = v.withColumn("node", F.when(F.col("ok"), F.xxhash64("label", F.transform("embedding", lambda x: x + F.lit(0.0)))))
    nodes = stage(v.filter("ok").groupBy("node").agg(F.first("label").alias("label"), F.first("embedding").alias("embedding"),
                                                     F.min("vec_id").alias("low"), F.count("*").alias("copies")), "vectors")
    largest = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = shape(largest, threshold, miss)

    def sign(batches):
        for b in batches:
            offs = b.column("embedding").offsets.to_numpy()
            flat = b.column("embedding").flatten().to_numpy(zero_copy_only=False)
            size = np.diff(offs)
            offs = offs - offs[0]
            codes = np.zeros((b.num_rows, tables), np.int64)
            blobs = [b""] * b.num_rows
            for d in np.unique(size):
                rows = np.flatnonzero(size == d)
                x = np.stack([flat[offs[r]:offs[r] + d] for r in rows]).astype(np.float64)
                x /= np.abs(x).max(1, keepdims=True)
                x /= np.sqrt((x * x).sum(1, keepdims=True))
                s = (x @ planes(int(d), tables, bits) > 0).reshape(len(rows), tables, bits)
                codes[rows] = s @ (1 << np.arange(bits, dtype=np.int64))
                for r, y in zip(rows, x):
                    blobs[r] = y.tobytes()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * tables), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("bucket"), b.column("copies"), pa.array(size.astype(np.int32)), pa.array(blobs, pa.binary()), lists],
                                             ["node", "label", "copies", "dim", "unit", "codes"])

    label_key = F.xxhash64("label")  # any type of label
    signed = stage(nodes.select("node", label_key.alias("bucket"), "copies", "embedding").mapInArrow(
        sign, "node long, label long, copies long, dim int, unit binary, codes array<long>"), "signs")
    keyed = signed.select("*", F.posexplode("codes").alias("table", "code"))
    keyed = keyed.withColumn("key", F.xxhash64("label", "dim", "table", "code"))
    hot = keyed.groupBy("key").count().filter(F.col("count") > tile).select("key", F.ceil(F.col("count") / tile).cast("int").alias("split"))
    keyed = keyed.join(hot, "key", "left").withColumn("split", F.coalesce("split", F.lit(1)))
    keyed = keyed.withColumn("slot", F.pmod(F.xxhash64("node", "table"), F.col("split")).cast("int"))
    keyed = keyed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("split") - 1)))
    keyed = keyed.select("key", F.least("slot", "other").alias("a"), F.greatest("slot", "other").alias("b"), "slot", "table", "node", "copies", "unit", "codes")

    def compare(key, t):
        schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("to", pa.int64())])
        n = t.num_rows
        slot, node, copies = (t.column(c).to_numpy() for c in ("slot", "node", "copies"))
        x = np.stack(_matrix(t.column("unit")))
        codes = pa.concat_arrays(t.column("codes").chunks).flatten().to_numpy().reshape(n, -1)
        table = int(t.column("table")[0].as_py())
        a, b = key[1].as_py(), key[2].as_py()
        left, right = np.flatnonzero(slot == a), np.flatnonzero(slot == b)
        links = np.zeros(n, np.int64)
        li, lj = [], []
        for s in range(0, len(left), 256):
            i = left[s:s + 256]
            dot = x[i] @ x[right].T
            p, q = np.nonzero(dot >= threshold - 1e-9)
            p, q, d = i[p], right[q], dot[p, q]
            if a == b:
                once = p < q
                p, q, d = p[once], q[once], d[once]
            near = np.abs(d - threshold) < 1e-9
            if near.any():
                d[near] = (x[p[near]] * x[q[near]]).sum(1)
                keep = d >= threshold - 4e-16
                p, q = p[keep], q[keep]
            first = np.ones(len(p), bool)
            for c in range(0, len(p), 1 << 16):
                y = slice(c, c + (1 << 16))
                first[y] = ~(codes[p[y], :table] == codes[q[y], :table]).any(1)
            np.add.at(links, p[first], copies[q[first]])
            np.add.at(links, q[first], copies[p[first]])
            # a spanning set of the links so far is all that later steps need
            li.append(p)
            lj.append(q)
            if sum(map(len, li)) > 1 << 20:
                low = _local_components(n, np.concatenate(li), np.concatenate(lj))
                li, lj = [np.arange(n)], [low]
        to = _local_components(n, np.concatenate(li), np.concatenate(lj)) if li else np.arange(n)
        some = (links > 0) | (to != np.arange(n))
        return pa.table([node[some], links[some], node[to[some]]], schema=schema)

    tiles = stage(keyed.groupBy("key", "a", "b").applyInArrow(compare, "node long, links long, to long"), "links")
    links = tiles.groupBy("node").agg(F.sum("links").alias("links"))
    comp = components(spark, tiles.select(F.col("node").alias("src"), F.col("to").alias("dst")))
    comp = nodes.select("node", "low", "copies").join(comp, nodes.node == comp.id, "left").select(
        "node", "low", "copies", F.coalesce("component_id", "node").alias("c"))
    least = comp.groupBy("c").agg(F.min("low").alias("component_id"))
    known = comp.join(least, "c").join(links, "node", "left").select(
        "node", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    out = v.select("vec_id", "ok", "node").join(known, "node", "left")
    component = F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      component.eqNullSafe(F.col("vec_id")).alias("kept"))


def op8_embedding_duplicates(spark, sf_dir: str) -> DataFrame:
    from daystream.session import read_table
    return embedding_duplicates(read_table(spark, sf_dir, "embeddings"))


OP8_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x for x in embedding if x <> 0]) > 0),
link AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(x, y) AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
low AS (SELECT x, min(y) AS y FROM reach GROUP BY x),
n AS (SELECT x, count(*) AS n FROM link GROUP BY x)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(low.y, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(low.y, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN low ON low.x = e.vec_id LEFT JOIN n ON n.x = e.vec_id
"""
