"""Plan regression tests: the physical plans keep the properties the
engine relies on at scale."""

import re

from daystream import schemas
from daystream.operators import dau, log_split
from daystream.operators.parse import parse_log
from daystream.plans import catalog
from daystream.session import scratch_path
from daystream.sinks.upsert import read_table, touched_partitions, upsert_partitions
from daystream.sources.envelopes import log_envelopes_from

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_log_routing_is_one_pass(spark):
    p = plan(log_split.route_messages(parse_log(log_envelopes_from(spark, SF))))
    assert p.count("from_json") == 1          # one parse per message
    assert "Exchange" not in p                # map-only: no shuffle
    assert len(re.findall(r"FileScan parquet", p)) == 1
    scan = re.search(r"ReadSchema: (struct<[^>]*>)", p).group(1)
    assert scan == "struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>"


def test_filters_stay_above_the_parse(spark):
    p = plan(dau.session_first_pages(log_split.page_log(parse_log(
        log_envelopes_from(spark, SF)))))
    assert p.count("from_json") == 1


def test_first_seen_aggregates_before_the_shuffle(spark):
    p = plan(catalog._first_seen(spark, SF))
    assert "partial_min_by" in p
    assert p.index("partial_min_by") > p.index("Exchange hashpartitioning(dt")


def test_seen_set_read_is_partition_pruned(spark):
    path = scratch_path(spark, "plan-dau")
    d = catalog._dau(spark, SF)
    upsert_partitions(spark, d, path, ["dt", "mid"])
    first = catalog._first_seen(spark, SF).where("dt >= '2024-01-20'")
    stored = read_table(spark, path, schemas.DAU_INFO).select("dt", "mid")
    p = plan(dau.new_only(first, touched_partitions(stored, first, "dt")))
    assert re.search(r"PartitionFilters: \[[^\]]*\(dt#\d+ >= 2024-01-2", p)


def test_one_scan_per_dimension_source(spark):
    """Files listed once per source, whatever the number of versions made of a row."""
    def scans(df, table):
        return len(re.findall(rf"FileScan parquet .*{table}\.parquet", plan(df)))
    info = catalog.q_dau_info(spark, SF)
    assert scans(info, "customer") == 1 and scans(info, "nation") == 1
    assert scans(catalog.q_dau_province_join(spark, SF), "customer") == 0


def test_arrivals_are_not_shuffled(spark, tmp_path, monkeypatch):
    """Each stretch is written by the tasks that hold its rows, whole and in time order; both ways give the same rows."""
    from pyspark.sql import DataFrame, functions as F
    from daystream.plans import catalog
    monkeypatch.setattr(DataFrame, "repartitionByRange", None)
    rows = spark.range(0, 100, 1, 4).select("id", F.timestamp_millis(F.col("id") * 1000).alias("timestamp"))
    for keep in (True, False):
        src, seen = str(tmp_path / f"src{keep}"), []
        catalog._arrive_in_slices(spark, rows, src, lambda: seen.append(
            sorted(r.id for r in spark.read.option("recursiveFileLookup", "true").schema("id long").parquet(src).collect())), keep=keep)
        assert seen == [list(range(n)) for n in (33, 66, 100)] or (len(seen) == 3 and seen[2] == list(range(100)) and all(
            s == list(range(len(s))) for s in seen) and 0 < len(seen[0]) < len(seen[1]) < 100)
