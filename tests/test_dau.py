"""Daily active users: session filter, first seen, dimensions, upsert."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daystream import schemas
from daystream.functions.dates import age_years, dt_of, hr_of
from daystream.operators import dau
from daystream.sinks.upsert import read_table, upsert_partitions
from daystream.session import scratch_path

MIDNIGHT = 1704153600000  # 2024-01-02T00:00:00Z


def page(mid, ts, last=None, uid="1", prov="1", part=0, off=0, page_id="home"):
    return (mid, uid, prov, "ch", "0", "md", "os", "vc", "ba", page_id, last, "7", "sku",
            10, "query", ts, part, off)


PAGE_SCHEMA = T.StructType(schemas.PAGE_LOG.fields + [
    T.StructField("src_partition", T.IntegerType()), T.StructField("src_offset", T.LongType())])


def pages_df(spark, rows):
    return spark.createDataFrame(rows, PAGE_SCHEMA)


def test_session_first_only_null(spark):
    p = pages_df(spark, [page("a", 1, None), page("b", 2, ""), page("c", 3, "home")])
    assert [r.mid for r in dau.session_first_pages(p).collect()] == ["a"]


def test_first_seen_tie_break_and_day_boundary(spark):
    rows = [page("a", MIDNIGHT - 1, off=5), page("a", MIDNIGHT, off=1, page_id="x"),
            page("a", MIDNIGHT, part=0, off=0, page_id="y"), page("a", MIDNIGHT + 5, off=0),
            page("b", MIDNIGHT + 9, part=1, off=3)]
    got = {(r.dt, r.mid): r.page_id
           for r in dau.first_seen(pages_df(spark, rows), tz="UTC").collect()}
    assert got == {("2024-01-01", "a"): "home", ("2024-01-02", "a"): "y",
                   ("2024-01-02", "b"): "home"}
    # the calendar day follows the chosen zone
    got_sh = {r.dt for r in dau.first_seen(pages_df(spark, rows), tz="Asia/Shanghai")
              .collect()}
    assert got_sh == {"2024-01-02"}


def test_first_seen_independent_of_order(spark):
    rows = [page(f"m{k % 7}", MIDNIGHT + (k * 7919) % 100000, part=k % 3, off=k)
            for k in range(60)]
    base = sorted(tuple(r) for r in dau.first_seen(pages_df(spark, rows), tz="UTC").collect())
    random.Random(1).shuffle(rows)
    again = sorted(tuple(r) for r in dau.first_seen(pages_df(spark, rows).repartition(5),
                                                    tz="UTC").collect())
    assert base == again


@pytest.mark.parametrize("birthday,as_of,age", [
    ("2000-02-29", "2001-02-28", "0"), ("2000-02-29", "2001-03-01", "1"),
    ("2000-02-29", "2004-02-28", "3"), ("1990-05-10", "2024-05-10", "34"),
    ("1990-05-10", "2024-05-09", "33"), ("1990-2-30", "2024-01-01", None)])
def test_age_calendar_years(spark, birthday, as_of, age):
    df = spark.createDataFrame([(birthday,)], "b string")
    assert df.select(age_years("b", as_of).alias("a")).collect()[0].a == age


def test_dt_hr(spark):
    df = spark.createDataFrame([(MIDNIGHT - 1,), (MIDNIGHT,)], "ts long")
    got = [(r.dt, r.hr) for r in df.select(dt_of("ts", "UTC").alias("dt"),
                                           hr_of("ts", "UTC").alias("hr")).collect()]
    assert got == [("2024-01-01", "23"), ("2024-01-02", "00")]


def test_dau_info_missing_dims_keep_row(spark):
    p = dau.first_seen(pages_df(spark, [page("a", MIDNIGHT, uid="1", prov="1"),
                                        page("b", MIDNIGHT, uid="404", prov="99")]), tz="UTC")
    users = spark.createDataFrame([("1", "F", "2000-02-29")],
                                  "user_id string, user_gender string, birthday string")
    prov = spark.createDataFrame([("1", "P", "ISO", "CN-1", "110000")],
                                 "province_id string, province_name string, "
                                 "province_iso_code string, province_3166_2 string, "
                                 "province_area_code string")
    out = {r.mid: r for r in dau.dau_info(p, users, prov, as_of="2024-01-31", tz="UTC")
           .collect()}
    assert out["a"].user_age == "23" and out["a"].province_name == "P"
    assert out["b"].user_gender is None and out["b"].province_name is None
    assert list(dau.dau_info(p, users, prov, tz="UTC").columns) == schemas.DAU_INFO.names


def _dau_rows(spark, rows):
    df = spark.createDataFrame(rows, schemas.DAU_INFO)
    return df


def _row(dt, mid, channel="c"):
    vals = {n: None for n in schemas.DAU_INFO.names}
    vals.update(dt=dt, mid=mid, channel=channel, ts=1, during_time=1)
    return tuple(vals[n] for n in schemas.DAU_INFO.names)


def test_upsert_idempotent_and_replacing(spark):
    path = scratch_path(spark, "test-dau")
    a = _dau_rows(spark, [_row("2024-01-01", "m1"), _row("2024-01-02", "m1")])
    upsert_partitions(spark, a, path, ["dt", "mid"])
    upsert_partitions(spark, a, path, ["dt", "mid"])
    assert read_table(spark, path, schemas.DAU_INFO).count() == 2
    b = _dau_rows(spark, [_row("2024-01-02", "m1", "new"), _row("2024-01-02", "m2")])
    upsert_partitions(spark, b, path, ["dt", "mid"])
    got = {(r.dt, r.mid): r.channel for r in read_table(spark, path, schemas.DAU_INFO)
           .collect()}
    assert got == {("2024-01-01", "m1"): "c", ("2024-01-02", "m1"): "new",
                   ("2024-01-02", "m2"): "c"}
    seen = dau.seen_mids(read_table(spark, path, schemas.DAU_INFO))
    cand = spark.createDataFrame([("2024-01-02", "m2"), ("2024-01-02", "m3"),
                                  ("2024-01-03", "m1")], "dt string, mid string")
    assert sorted(tuple(r) for r in dau.new_only(cand, seen).collect()) == \
        [("2024-01-02", "m3"), ("2024-01-03", "m1")]


def test_funnel_counts(spark):
    p = pages_df(spark, [page("a", MIDNIGHT), page("a", MIDNIGHT + 1), page("b", 5, "x")])
    got = {r.stage: r.rows for r in dau.funnel_counts(p).collect()}
    assert got["pages"] == 3 and got["session_first"] == 2 and got["first_seen"] == 1
    assert F is not None


def test_compaction_keeps_rows_and_cuts_files(spark):
    import os

    from daystream.sinks.upsert import append_partitions, compact_partitions
    path = scratch_path(spark, "compact")
    for k in range(4):
        rows = [_row(f"2024-01-0{1 + (k % 2)}", f"m{k}{j}") for j in range(5)]
        append_partitions(_dau_rows(spark, rows).repartition(3), path)

    def files():
        return sum(f.endswith(".parquet") for _, _, fs in os.walk(path) for f in fs)
    before = sorted(map(tuple, read_table(spark, path, schemas.DAU_INFO).collect()))
    n_before = files()
    compact_partitions(spark, path, schemas.DAU_INFO, "dt", ["dt", "mid"])
    after = sorted(map(tuple, read_table(spark, path, schemas.DAU_INFO).collect()))
    assert after == before and len(after) == 20
    assert files() < n_before


def test_ledger_compaction(spark):
    from messages import envelopes

    from daystream.plans import jobs
    path = scratch_path(spark, "ledger-compact")
    for b in range(3):
        jobs.save_ledger(spark, path, envelopes(spark, ["x"] * 3, start_offset=10 * b), "g", b)
    before = sorted(map(tuple, jobs.read_ledger(spark, path).collect()))
    jobs.compact_ledger(spark, path)
    assert sorted(map(tuple, jobs.read_ledger(spark, path).collect())) == before == \
        [("g", "ODS_BASE_LOG", 0, 23, 2)]
    assert spark.read.parquet(path).count() == 1


def test_seen_devices_missing_table_and_days(spark):
    from daystream.plans import jobs
    path = scratch_path(spark, "seen")
    assert jobs.seen_devices(spark, path).count() == 0
    upsert_partitions(spark, _dau_rows(spark, [_row("2024-01-01", "a"), _row("2024-01-02", "b"),
                                               _row("2024-01-02", "c")]), path, ["dt", "mid"])
    assert sorted(map(tuple, jobs.seen_devices(spark, path, ["2024-01-02"]).collect())) == \
        [("2024-01-02", "b"), ("2024-01-02", "c")]
    assert jobs.seen_devices(spark, path).count() == 3
