"""Stored messages read from positions, fenced saves, recorded lists, funnel records."""

import json

import pytest
from messages import envelopes
from pyspark.sql import functions as F

from daystream import schemas
from daystream.operators import cdc, ledger
from daystream.plans import jobs
from daystream.session import scratch_path
from daystream.sinks import fence, funnel_log
from daystream.sinks.manifest import StaleWriter
from daystream.sinks.message_log import append_log, read_from_positions
from daystream.sinks.routing_log import recorded_routing
from daystream.sources.envelopes import change_envelopes_from, routing_table

SF = "/root/testdata/sf0.001"


def _scan_rows(df):
    """Rows that the file scan of an executed plan gave out."""
    nodes, out = [df._jdf.queryExecution().executedPlan()], 0
    while nodes:
        n = nodes.pop()
        kids = n.children()
        nodes += [kids.apply(i) for i in range(kids.size())]
        if "Scan" in n.nodeName() and n.metrics().contains("numOutputRows"):
            out += n.metrics().apply("numOutputRows").value()
    return out


def test_positions_reach_the_scan(spark):
    path = scratch_path(spark, "mlog")
    parts = [envelopes(spark, ["v"] * 2000, partition=p) for p in range(3)]
    env = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(envelopes(spark, ["o"] * 50, topic="OTHER"))
    env = env.withColumn("value", F.concat(F.sha2(F.concat("partition", "offset").cast("string"), 512), F.sha2(F.col("offset").cast("string"), 512)))
    append_log(env, path, row_group=64 << 10)
    append_log(envelopes(spark, ["late"] * 10, partition=0, start_offset=2000), path)
    saves = spark.createDataFrame(
        [("g", "ODS_BASE_LOG", 0, 1995, 1), ("g", "ODS_BASE_LOG", 1, 2000, 1), ("g", "ODS_BASE_LOG", 2, None, 1), ("h", "ODS_BASE_LOG", 0, 3, 1)],
        "group_id string, topic string, partition int, until_offset long, batch_id long")
    for group in ("g", "h", "nobody"):
        rest = read_from_positions(spark, path, saves, group, "ODS_BASE_LOG")
        want = ledger.read_from_offsets(env.unionByName(envelopes(spark, ["late"] * 10, partition=0, start_offset=2000)), saves, group, "ODS_BASE_LOG")
        cols = schemas.ENVELOPE.names
        assert sorted(map(repr, rest.collect())) == sorted(map(repr, want.select(*cols).collect()))
    only = saves.withColumn("until_offset", F.coalesce("until_offset", F.lit(1990)))
    rest = read_from_positions(spark, path, only, "g", "ODS_BASE_LOG")
    text = rest._jdf.queryExecution().executedPlan().toString()
    # the plan's text is cut, but an Or is pushed whole or not at all
    assert "PushedFilters: [Or(Or(And(EqualTo(partition,0),GreaterThanOrEqual(offset,1995))" in text
    assert "topic=ODS_BASE_LOG" in text or "PartitionFilters: [isnotnull(topic" in text
    assert len(rest.collect()) == 25
    assert 25 <= _scan_rows(rest) < 3000  # row groups behind the positions aren't decoded


def test_many_partitions_are_one_condition(spark):
    path = scratch_path(spark, "mlog")
    append_log(envelopes(spark, ["v"] * 3, partition=7), path)
    saves = spark.range(500).select(F.lit("g").alias("group_id"), F.lit("ODS_BASE_LOG").alias("topic"),
                                    F.col("id").cast("int").alias("partition"), F.lit(2).cast("long").alias("until_offset"))
    assert [r.offset for r in read_from_positions(spark, path, saves, "g", "ODS_BASE_LOG").collect()] == [2]


def test_an_overtaken_run_cannot_save(spark):
    path = scratch_path(spark, "fl")
    env = envelopes(spark, ["x"] * 6)
    one = fence.begin_run(spark, path)
    jobs.save_ledger(spark, path, env, "g", 9, one)
    two = fence.begin_run(spark, path)
    assert (one, two) == (1, 2)
    with pytest.raises(StaleWriter):
        jobs.save_ledger(spark, path, env, "g", 10, one)
    # the second run's driver has its clock set back by a day
    rows = ledger.save_rows(ledger.offset_ranges(env.where("offset < 2")), "g", 0, two)
    rows.withColumn("saved_at", F.col("saved_at") - F.expr("interval 1 day")).write.mode("append").parquet(path)
    assert [(r.until_offset, r.batch_id) for r in jobs.read_ledger(spark, path).collect()] == [(2, 0)]
    jobs.compact_ledger(spark, path)  # keeps the run of a position
    assert fence.begin_run(spark, path) >= 1
    rows = ledger.save_rows(ledger.offset_ranges(env), "g", 99, one).write.mode("append").parquet(path)
    assert [r.until_offset for r in jobs.read_ledger(spark, path).collect()] == [2]


def test_two_runs_never_share_a_number(spark, monkeypatch):
    path = scratch_path(spark, "fl")
    assert fence.begin_run(spark, path) == 1
    real, first = fence.read_manifest, []

    def stale(*a):  # the first look is from before the other run's start
        if not first:
            first.append(1)
            return 0, {}
        return real(*a)

    monkeypatch.setattr(fence, "read_manifest", stale)
    assert fence.begin_run(spark, path) == 2


def test_an_overtaken_job_writes_nothing(spark):
    out = scratch_path(spark, "fj")
    env = envelopes(spark, [json.dumps({"common": {"mid": "m"}, "page": {"page_id": "p", "during_time": 1}, "ts": 5})])
    old = fence.begin_run(spark, f"{out}/ledger")
    new = fence.begin_run(spark, f"{out}/ledger")
    with pytest.raises(StaleWriter):
        jobs.process_log_batch(spark, env, out, 0, run_id="old", fence=old)
    jobs.process_log_batch(spark, env, out, 0, run_id="new", fence=new)
    assert {r["run"] for r in spark.read.parquet(f"{out}/topics").select("run").collect()} == {"new"}


def test_lists_of_the_first_try(spark):
    path = scratch_path(spark, "rl")
    lists = lambda *rows: spark.createDataFrame(rows, "table string, kind string")
    got = lambda df: {(r.table, r.kind) for r in df.collect()}
    a, b = lists(("t", "fact"), ("t", "fact")), lists(("t", "dim"))
    assert got(recorded_routing(spark, path, "r", 0, a)) == {("t", "fact")}
    assert got(recorded_routing(spark, path, "r", 0, b)) == {("t", "fact")}
    assert got(recorded_routing(spark, path, "r", 1, b)) == {("t", "dim")}
    assert got(recorded_routing(spark, path, "r", 2, lists(("t", "fact")).limit(0))) == set()
    assert got(recorded_routing(spark, path, "r", 2, b)) == set()


def test_messages_of_the_change_split_in_one_pass(spark):
    """Equal to the facts and the dead letters apart; one scan and one parse per source."""
    lists = routing_table(spark).unionByName(spark.createDataFrame([("user_info", "fact"), ("x", "other")], "table string, kind string"))
    odd = envelopes(spark, ["{", " ", None, '{"type":"insert","data":{"id":1}}', '{"type":"insert","table":"user_info","data":{"gender":"M"}}',
                            '{"type":"insert","table":"order_info","data":{"id":3}}', '{"type":"ddl","table":"order_info"}',
                            '{"type":"update","table":"nowhere","data":{"id":3}}'], topic="ODS_BASE_DB")
    changes = cdc.parse_changes(change_envelopes_from(spark, SF, tables=("user_info", "order_info")).unionByName(odd))
    both = cdc.route_messages(changes, lists, key="id")
    facts = cdc.fact_route(cdc.with_op(changes), lists, key="id").select("topic", "key", "value")
    dead = cdc.change_dead_letter(changes, lists).select(F.coalesce("value", F.lit("")).alias("value"))
    got = [tuple(r) for r in both.collect()]
    assert sorted(map(repr, [g for g in got if "DEAD" not in g[0]])) == sorted(repr(tuple(r)) for r in facts.collect())
    assert sorted(g[2] for g in got if "DEAD" in g[0]) == sorted(r.value for r in dead.collect())
    assert sum("DEAD" in g[0] for g in got) == 5
    one = cdc.route_messages(cdc.parse_changes(change_envelopes_from(spark, SF, tables=("order_info",))), routing_table(spark))
    p = one._jdf.queryExecution().executedPlan().toString()
    assert p.count("FileScan parquet") == 1 and p.count("from_json") == 1


def test_a_replay_keeps_the_counts_of_the_first_try(spark):
    page = lambda mid, ts, last=None: json.dumps({"mid": mid, "ts": ts, "last_page_id": last, "user_id": "1"})
    env = envelopes(spark, [page("a", 1000), page("a", 2000), page("b", 3000, "p"), "junk"], topic="DWD_PAGE_LOG_TOPIC_20220629")
    out = scratch_path(spark, "fn")
    dims = jobs.read_dims(spark, scratch_path(spark, "no-dims"))
    for _ in range(2):
        jobs.process_page_messages(spark, env, dims, out, 0, tz="UTC", funnel=True)
    jobs.process_page_messages(spark, env, dims, out, 1, tz="UTC", funnel=True)
    log = funnel_log.read_counts(spark, f"{out}/funnel")
    by_batch = {(r.batch_id, r.stage): r.n for r in log.groupBy("batch_id", "stage").agg(F.sum("rows").alias("n")).collect()}
    assert by_batch[(0, "pages")] == 3 and by_batch[(0, "session_first")] == 2 and by_batch[(0, "first_seen")] == 1
    assert by_batch[(1, "pages")] == 3 and by_batch.get((1, "first_seen"), 0) == 0
    assert log.where("task is null").count() == 0
