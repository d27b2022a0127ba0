"""Versions of partitions, manifests, the dimension index and the index of stored devices."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from daystream.session import scratch_path
from daystream.sinks import dim_index, dims, fence, manifest, seen_index, upsert, versions

SCHEMA = StructType([StructField("mid", StringType()), StructField("n", IntegerType()), StructField("dt", StringType())])


def rows(spark, *r):
    return spark.createDataFrame(list(r), SCHEMA)


def stored(spark, path):
    return {tuple(r) for r in versions.read_versions(spark, path, SCHEMA).collect()}


def test_upsert_replaces_and_adds(spark):
    path = scratch_path(spark, "ver")
    assert stored(spark, path) == set()
    versions.upsert_versions(spark, rows(spark, ("a", 1, "d1"), ("b", 1, "d1"), ("a", 1, "d2")), path, ["dt", "mid"])
    held = versions.read_versions(spark, path, SCHEMA)
    versions.upsert_versions(spark, rows(spark, ("a", 2, "d1"), ("c", 2, "d3")), path, ["dt", "mid"])
    assert stored(spark, path) == {("a", 2, "d1"), ("b", 1, "d1"), ("a", 1, "d2"), ("c", 2, "d3")}
    # a reader keeps the versions it found
    assert {tuple(r) for r in held.collect()} == {("a", 1, "d1"), ("b", 1, "d1"), ("a", 1, "d2")}
    assert versions.upsert_versions(spark, rows(spark), path, ["dt", "mid"]) == 2
    assert len(versions.drop_versions(spark, path)) == 0  # d2 is still in the first version
    versions.upsert_versions(spark, rows(spark, ("a", 3, "d2")), path, ["dt", "mid"])
    assert len(versions.drop_versions(spark, path)) == 1
    assert stored(spark, path) == {("a", 2, "d1"), ("b", 1, "d1"), ("a", 3, "d2"), ("c", 2, "d3")}


def test_stopped_before_the_switch(spark, monkeypatch):
    path = scratch_path(spark, "ver")
    versions.upsert_versions(spark, rows(spark, ("a", 1, "d1")), path, ["dt", "mid"])

    def stop(*a):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(versions, "commit", stop)
        with pytest.raises(KeyboardInterrupt):
            versions.upsert_versions(spark, rows(spark, ("a", 2, "d1")), path, ["dt", "mid"])
    assert stored(spark, path) == {("a", 1, "d1")}
    versions.upsert_versions(spark, rows(spark, ("a", 3, "d1")), path, ["dt", "mid"])
    assert stored(spark, path) == {("a", 3, "d1")}


def test_second_writer_fails_and_loses_nothing(spark, monkeypatch):
    path = scratch_path(spark, "ver")
    versions.upsert_versions(spark, rows(spark, ("a", 1, "d1")), path, ["dt", "mid"])
    seen = manifest.read_manifest(spark, path)
    versions.upsert_versions(spark, rows(spark, ("b", 1, "d1")), path, ["dt", "mid"])
    with monkeypatch.context() as m:  # read the manifest before the other writer switched
        m.setattr(versions, "read_manifest", lambda *a: seen)
        with pytest.raises(manifest.StaleWriter):
            versions.upsert_versions(spark, rows(spark, ("c", 1, "d1")), path, ["dt", "mid"])
    assert stored(spark, path) == {("a", 1, "d1"), ("b", 1, "d1")}


def test_unfinished_manifest_does_not_count(spark):
    path = scratch_path(spark, "man")
    assert manifest.read_manifest(spark, path) == (0, {})
    manifest.commit(spark, path, 1, {"x": "é"})
    p, fs = manifest._fs(spark, f"{path}/_manifest/{2:012d}.json")
    fs.create(p, False).close()
    assert manifest.read_manifest(spark, path) == (1, {"x": "é"})
    with pytest.raises(manifest.StaleWriter):
        manifest.commit(spark, path, 2, {})


def _dim(spark, values, order):
    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=order)
    return spark.createDataFrame([("user_info", str(i), v, op, 0, order, at) for i, v, op in values],
                                 "table string, id string, data string, op string, src_partition int, src_offset long, src_ts timestamp")


def test_lookup_reads_the_buckets_of_the_ids(spark):
    store, index = scratch_path(spark, "ds"), scratch_path(spark, "di")
    dims.append_dims(_dim(spark, [(i, f"v{i}", "I") for i in range(3000)], 1), store, "r", 0, "drop")
    ids = spark.createDataFrame([(str(i),) for i in range(0, 2000, 200)] + [(None,), ("gone",)], "user_id string")
    assert dim_index.lookup(spark, store, index, "user_info", ids).count() == 10  # nothing folded yet
    assert dim_index.fold(spark, store, index) == 1 and dim_index.fold(spark, store, index) == 0
    dims.append_dims(_dim(spark, [(200, "new", "U"), (400, "x", "D")], 2), store, "r", 1, "drop")
    want = {str(i): "new" if i == 200 else f"v{i}" for i in range(0, 2000, 200) if i != 400}

    def check():
        found = dim_index.lookup(spark, store, index, "user_info", ids)
        assert {r.id: r.data for r in found.collect()} == want
        whole = dims.read_dims(spark, store, ("user_info",)).join(ids, F.col("id") == F.col("user_id"), "left_semi")
        assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, found.select(*whole.columns).collect()))
        return dim_index.lookup_rows(spark, store, index, "user_info", ids)

    files = check().inputFiles()
    assert len([f for f in files if f"{index}/".split("/")[-2] in f]) <= 10 + 2
    every = check()
    scanned = sum(spark.read.parquet(f).count() for f in files)
    assert scanned < 3000 / 4 and every.count() == 12
    dim_index.fold(spark, store, index)
    check()
    for b in range(2, 5):  # levels become a base
        dims.append_dims(_dim(spark, [(600, "v600", "U")], b + 1), store, "r", b, "drop")
        dim_index.fold(spark, store, index, max_levels=2)
        check()
    assert len(manifest.read_manifest(spark, index)[1]["levels"]) <= 2


def _first(spark, rows):
    return spark.createDataFrame(rows, "mid string, dt string")


def test_seen_index_reads_the_buckets_of_the_devices(spark):
    path, index = scratch_path(spark, "sd"), scratch_path(spark, "si")
    days = ["2024-01-01", "2024-01-02"]
    ask = spark.createDataFrame([(f"m{i}", days[0]) for i in range(0, 4000, 400)]
                                + [("new", days[0]), ("m1", "2024-01-09"), (None, days[0]), ("m2", None)], "mid string, dt string")
    assert seen_index.seen_keys(spark, path, index, ask).count() == 0  # no table yet
    upsert.append_partitions(_first(spark, [(f"m{i}", d) for i in range(3000) for d in days]), path)

    def check(most):
        rows = seen_index.seen_rows(spark, path, index, ask)
        want = {(r.mid, r.dt) for r in spark.read.schema("mid string, dt string").parquet(path).collect()}
        want &= {(r.mid, r.dt) for r in ask.collect()}
        found = [tuple(r) for r in seen_index.seen_keys(spark, path, index, ask).select("mid", "dt").collect()]
        assert set(found) == want and len(found) == len(want)
        files = rows.inputFiles()
        assert not any(days[1] in f for f in files) and len(files) <= most
        return rows, files

    check(20)  # nothing folded: the files of the day
    folded = seen_index.fold_seen(spark, path, index, bucket_bytes=1000)
    assert folded > 0 and seen_index.fold_seen(spark, path, index) == 0
    rows, files = check(13)
    assert all("bucket=" in f for f in files)
    assert spark.read.parquet(*files).count() < 3000 * 0.75
    p = rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\n]*In\(mid, \[", p)
    # stored after the fold: found in its own file; then levels become one
    for k in range(2):
        upsert.append_partitions(_first(spark, [(f"m{i}", days[0]) for i in range(3000 + 600 * k, 3600 + 600 * k)]), path)
        check(13 * (k + 2) + 8)
        seen_index.fold_seen(spark, path, index, [days[0]], max_levels=2, bucket_bytes=2000)
        check(13 * 2)
    assert len(manifest.read_manifest(spark, f"{index}/dt={days[0]}")[1]["levels"]) <= 2
    # a rewrite gives new files with the same keys
    upsert.compact_partitions(spark, path, T.StructType.fromDDL("mid string, dt string"), "dt", ["dt", "mid"])
    check(13 * 2 + 8)
    seen_index.fold_seen(spark, path, index, max_levels=2)  # small days: one bucket
    check(13 * 2)


def test_seen_index_of_large_batches_and_second_writers(spark, monkeypatch):
    path, index = scratch_path(spark, "sd"), scratch_path(spark, "si")
    day = "2024-01-01"
    upsert.append_partitions(_first(spark, [(f"m{i}", day) for i in range(2000)]), path)
    seen_index.fold_seen(spark, path, index)
    ask = _first(spark, [(f"m{i}", day) for i in range(1000, 3000)])  # more than the list of keys takes
    assert seen_index.seen_keys(spark, path, index, ask).count() == 1000
    held = manifest.read_manifest(spark, f"{index}/dt={day}")
    for i in (1, 2):
        upsert.append_partitions(_first(spark, [(f"n{i}", day)]), path)
        if i == 1:
            seen_index.fold_seen(spark, path, index)
    with monkeypatch.context() as m:
        m.setattr(seen_index, "read_manifest", lambda *a: held)
        with pytest.raises(manifest.StaleWriter):
            seen_index.fold_seen(spark, path, index)
    ask = _first(spark, [("n1", day), ("n2", day), ("n3", day)])
    assert {r.mid for r in seen_index.seen_keys(spark, path, index, ask).collect()} == {"n1", "n2"}


def test_dimension_rows_of_fenced_runs_need_no_clock(spark, monkeypatch):
    store, index, ledger = scratch_path(spark, "ds"), scratch_path(spark, "di"), scratch_path(spark, "dl")
    ids = spark.createDataFrame([("1",), ("2",), ("3",)], "user_id string")

    def add(year, run, batch, fence, *pairs, op="U"):
        with monkeypatch.context() as m:  # the clock of the run's driver
            m.setattr(F, "current_timestamp", lambda: F.to_timestamp(F.lit(f"{year}-01-01 00:00:00")))
            dims.append_dims(_dim(spark, [(i, v, op) for i, v in pairs], 1), store, run, batch, "drop", fence)

    def check(want):
        for found in (dims.read_dims(spark, store, ("user_info",)), dim_index.lookup(spark, store, index, "user_info", ids)):
            assert {r.id: r.data for r in found.collect()} == want

    add(2040, "old", 7, None, (1, "plain"), (2, "plain"), (3, "plain"))
    one = fence.begin_run(spark, ledger)
    add(2030, "a", 0, one, (1, "a0"), (2, "a0"))
    add(2029, "a", 1, one, (1, "a1"))  # set back within the run
    check({"1": "a1", "2": "a0", "3": "plain"})
    dim_index.fold(spark, store, index)
    two = fence.begin_run(spark, ledger)
    add(2020, "b", 0, two, (1, "b0"))
    add(2019, "b", 1, two, (3, "gone"), op="D")
    check({"1": "b0", "2": "a0"})
    # what the first run managed to write after that orders behind
    add(2041, "a", 2, one, (1, "a2"), (2, "a2"))
    check({"1": "b0", "2": "a2"})
    old = dims.compact_dims(spark, store)
    check({"1": "b0", "2": "a2"})
    assert len(old) == 6
