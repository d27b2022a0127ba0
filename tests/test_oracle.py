"""Every registered query against its independent DuckDB answer (sf0.001)."""

import os

import pytest

import __spark_entry__ as entry
from daystream.plans.catalog import QUERIES
from daystream.plans.oracle import ORACLE_SQL
from tools.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = duck.execute(entry.oracle_sql()[name]).df()
    gc, gr = rows_of(got)
    wc, wr = rows_of(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["mid", "user_id"] and len(df.columns) == 23
    assert df.count() > 0


@pytest.mark.parametrize("name", ["date_parts", "dau_info", "offset_ranges", "read_from_offsets"])
def test_results_do_not_depend_on_session_zone(spark, duck, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = entry.queries()[name](spark, SF).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    want = duck.execute(entry.oracle_sql()[name]).df()
    assert rows_of(got) == rows_of(want)
