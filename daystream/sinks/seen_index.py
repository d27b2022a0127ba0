"""Which devices a day has counted already, asked for a batch's devices only.

The result table is the seen-set; a day of it holds every device of that day.
The index keeps the keys of its data files a second time, for each day in
*levels*: a level is split into buckets by the hash of ``mid``, as many as its
size asks for, one file each, sorted by ``mid``, with a Bloom filter and small pages. A batch opens the
buckets of its own devices and the data files that are not folded yet; few
devices are also pushed down as a key list, so that of a bucket only the pages
that may hold them are read.

The table stays the truth: a file counts until a manifest names it as folded, so
there is no moment at which a stored key is in neither. Rewriting a day
(``upsert_partitions``, ``compact_partitions``) gives new files with at least the
same keys; deleting keys from the table needs a new index.
"""

from __future__ import annotations

import math
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daystream.sinks.dim_index import bucket_of
from daystream.sinks.manifest import StaleWriter, commit, read_manifest
from daystream.sinks.upsert import _fs, list_folders, table_exists

#: Bytes of a day's data files that a bucket stands for (its keys are a small part of them).
BUCKET_BYTES = 64 << 20
#: Up to so many keys of a batch are pushed down as a list; more are met by the join alone.
KEY_LIST = 500
#: Longest list of equalities that the Parquet reader takes as such.
_IN_LIST = 10
_KEYS = "mid string, dt string"


def _files(spark: SparkSession, folder: str) -> dict[str, int]:
    """Data files of a day's folder and their bytes."""
    p, fs = _fs(spark, folder)
    if not fs.exists(p):
        return {}
    sizes = {f.getPath().getName(): f.getLen() for f in fs.listStatus(p) if f.isFile()}
    return {n: sizes[n] for n in sorted(sizes) if not n.startswith(("_", "."))}


def _read(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], _KEYS)
    return spark.read.schema(_KEYS).option("basePath", root).parquet(*paths).select("mid", "dt")


def _day_of(folder: str) -> str:
    return folder.rsplit("dt=", 1)[-1]


def _unfolded(spark: SparkSession, dau_path: str, day: str, manifest: dict) -> list[str]:
    folder, folded = f"{dau_path}/dt={day}", set(manifest.get("folded", []))
    return [f"{folder}/{n}" for n in _files(spark, folder) if n not in folded]


def _buckets_of(spark: SparkSession, index_path: str, day: str, level: str, buckets: set[int] | None = None) -> list[str]:
    return [f for f in list_folders(spark, f"{index_path}/keys/level={level}/dt={day}", 1)
            if buckets is None or int(f.rsplit("bucket=", 1)[-1]) in buckets]


def fold_seen(spark: SparkSession, dau_path: str, index_path: str, days: list[str] | None = None,
              max_levels: int = 8, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Fold the data files that aren't in the index yet (of ``days``, default
    all) into a new level; a day with ``max_levels`` gets one level in place of
    them all. Readers see a day's new level from its manifest's switch on, and
    the levels it replaces stay for readers that hold them. Returns the files folded.

    A level has a power of two of buckets, one for each ``bucket_bytes`` of the files folded
    into it or somewhat more. A second writer of a day fails
    (:class:`daystream.sinks.manifest.StaleWriter`) and changes nothing.
    """
    if days is None:
        days = [_day_of(f) for f in list_folders(spark, dau_path, 1)]
    name, work, sources = uuid.uuid4().hex[:12], {}, {}
    for day in days:
        number, m = read_manifest(spark, f"{index_path}/dt={day}")
        new = _unfolded(spark, dau_path, day, m)
        if not new:
            continue
        levels, present = m.get("levels", []), _files(spark, f"{dau_path}/dt={day}")
        whole = len(levels) >= max_levels
        size = sum(present.get(f.rsplit("/", 1)[-1], 0) for f in new) + (sum(lv["bytes"] for lv in levels) if whole else 0)
        n = 1 << max(0, math.ceil(size / bucket_bytes) - 1).bit_length()
        data, keys = sources.setdefault(n, ([], []))
        data.extend(new)
        if whole:
            keys.extend(f for lv in levels for f in _buckets_of(spark, index_path, day, lv["name"]))
        # names of files that a rewrite has dropped are forgotten
        folded = sorted((set(m.get("folded", [])) & set(present)) | {f.rsplit("/", 1)[-1] for f in new})
        level = {"name": name, "buckets": n, "bytes": size}
        work[day] = (number + 1, {"levels": [level] if whole else [*levels, level], "folded": folded})
    for n, (data, keys) in sources.items():
        rows = _read(spark, dau_path, data).unionByName(_read(spark, f"{index_path}/keys", keys))
        (rows.where("mid is not null").distinct().withColumn("level", F.lit(name)).withColumn("bucket", bucket_of("mid", n))
         .repartition("dt", "bucket").sortWithinPartitions("dt", "bucket", "mid")
         .write.mode("append").option("parquet.bloom.filter.enabled#mid", "true")
         .option("parquet.page.row.count.limit", "2000")
         .partitionBy("level", "dt", "bucket").parquet(f"{index_path}/keys"))
    lost = []
    for day, (number, content) in work.items():
        try:
            commit(spark, f"{index_path}/dt={day}", number, content)
        except StaleWriter:  # the other days are folded all the same
            lost.append(day)
    if lost:
        raise StaleWriter(f"folded by another writer: {', '.join(lost)}")
    return sum(len(data) for data, _ in sources.values())


def _any_of(column: str, values: list[str]):
    parts = [F.col(column).isin(values[i:i + _IN_LIST]) for i in range(0, len(values), _IN_LIST)]
    return reduce(lambda a, b: a | b, parts)


def seen_rows(spark: SparkSession, dau_path: str, index_path: str, candidates: DataFrame) -> DataFrame:
    """Stored ``(dt, mid)`` that may be those of ``candidates``: from the buckets of their
    devices in every level of their days, and from files not folded yet.

    What reaches the driver: the buckets of the batch's days (at most those of their
    levels), and its keys if there are no more than ``KEY_LIST``.
    """
    none = spark.createDataFrame([], _KEYS)
    if not table_exists(spark, dau_path):
        return none
    wanted = candidates.select("mid", "dt").where("mid is not null and dt is not null")
    days = sorted(r[0] for r in wanted.select("dt").distinct().collect())
    manifests = {d: read_manifest(spark, f"{index_path}/dt={d}")[1] for d in days}
    fresh, stored = [], []
    for n in sorted({lv["buckets"] for m in manifests.values() for lv in m.get("levels", [])}):
        mine = {}
        for d, b in wanted.select("dt", bucket_of("mid", n).alias("b")).distinct().collect():
            mine.setdefault(d, set()).add(b)
        for d in days:
            stored.extend(f for lv in manifests[d].get("levels", []) if lv["buckets"] == n
                          for f in _buckets_of(spark, index_path, d, lv["name"], mine[d]))
    for d in days:
        fresh.extend(_unfolded(spark, dau_path, d, manifests[d]))
    rows = _read(spark, f"{index_path}/keys", stored).unionByName(_read(spark, dau_path, fresh))
    keys = sorted(r[0] for r in wanted.select("mid").distinct().limit(KEY_LIST + 1).collect())
    return rows.where(_any_of("mid", keys)) if 0 < len(keys) <= KEY_LIST else rows


def seen_keys(spark: SparkSession, dau_path: str, index_path: str, candidates: DataFrame) -> DataFrame:
    """The ``(dt, mid)`` of ``candidates`` (staged) that are stored: what
    :func:`daystream.operators.dau.new_only` needs of the stored days."""
    rows = seen_rows(spark, dau_path, index_path, candidates)
    return rows.join(candidates.select("dt", "mid"), ["dt", "mid"], "left_semi").select("dt", "mid").distinct()
