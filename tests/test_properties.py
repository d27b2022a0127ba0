"""Property tests: input order does not change the first-seen keys, and
an upsert applied twice equals applying it once."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from daystream import schemas
from daystream.operators import dau
from daystream.session import scratch_path
from daystream.sinks.upsert import read_table, upsert_partitions

PAGE_SCHEMA = T.StructType(schemas.PAGE_LOG.fields + [
    T.StructField("src_partition", T.IntegerType()), T.StructField("src_offset", T.LongType())])
DAY = 86_400_000
BASE = 1704067200000

rows_st = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3 * DAY - 1),
                             st.integers(0, 3), st.integers(0, 50)),
                   min_size=1, max_size=30)


def _pages(spark, rows):
    data = [(f"m{m}", "1", "1", "c", "0", "md", "os", "v", "b", f"p{o}", None, "7", "sku", 1,
             "q", BASE + t, p, o) for m, t, p, o in rows]
    return spark.createDataFrame(data, PAGE_SCHEMA)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_st, seed=st.randoms())
def test_first_seen_order_free(spark, rows, seed):
    a = {tuple(r) for r in dau.first_seen(_pages(spark, rows), tz="UTC")
         .select("dt", "mid", "ts", "src_partition", "src_offset").collect()}
    shuffled = list(rows)
    seed.shuffle(shuffled)
    b = {tuple(r) for r in dau.first_seen(_pages(spark, shuffled).repartition(3), tz="UTC")
         .select("dt", "mid", "ts", "src_partition", "src_offset").collect()}
    assert a == b
    # one row per (dt, mid), and it is the minimum by (ts, partition, offset)
    want = {}
    for m, t, p, o in rows:
        k = (f"{1 + (t // DAY):02d}", f"m{m}")
        want[k] = min(want.get(k, (10 ** 18,)), (BASE + t, p, o))
    assert {(dt[-2:], mid): (ts, p, o) for dt, mid, ts, p, o in a} == want


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(keys=st.lists(st.tuples(st.integers(1, 3), st.integers(0, 20)), min_size=1,
                     max_size=20, unique=True))
def test_upsert_twice_is_once(spark, keys):
    path = scratch_path(spark, "prop-upsert")
    df = spark.createDataFrame([(f"2024-01-0{d}", f"m{m}", m) for d, m in keys],
                               "dt string, mid string, v long")
    upsert_partitions(spark, df, path, ["dt", "mid"])
    once = sorted(map(tuple, read_table(spark, path, df.schema).collect()))
    upsert_partitions(spark, df, path, ["dt", "mid"])
    twice = sorted(map(tuple, read_table(spark, path, df.schema).collect()))
    assert once == twice == sorted(map(tuple, df.collect()))


# ---------------------------------------------------------------- log routing

from messages import envelopes  # noqa: E402

from daystream.functions import routing as R  # noqa: E402
from daystream.operators import log_split  # noqa: E402
from daystream.operators.parse import parse_log  # noqa: E402

_COMMON = {"ar": "1", "ba": "b", "ch": "c", "is_new": "0", "md": "m", "mid": "mid_1",
           "os": "o", "uid": "7", "vc": "v"}

record_st = st.fixed_dictionaries({}, optional={
    "common": st.sampled_from([_COMMON, {"uid": "7"}]),
    "ts": st.sampled_from([1000, "1000", "x"]),
    "page": st.sampled_from([{"page_id": "p", "during_time": 5}, {"page_id": "p"}]),
    "displays": st.lists(st.one_of(st.none(), st.just({"item": 1, "order": 1})), max_size=3),
    "actions": st.lists(st.just({"action_id": "a", "ts": 1001}), max_size=3),
    "start": st.just({"entry": "icon", "loading_time": 3}),
    "err": st.just({"code": 1}),
})


def _model(rec):
    """Expected messages per topic of one record (the routing rules)."""
    out = {}

    def add(topic, n=1):
        if n:
            out[topic] = out.get(topic, 0) + n
    if "err" in rec:
        add(R.ERROR_TOPIC)
        return out
    ok_ts = rec.get("ts") in (1000, "1000")
    common = rec.get("common")
    page = rec.get("page")
    if (common is None or "mid" not in common or not ok_ts
            or (page is not None and "during_time" not in page)):
        add(R.DEAD_LETTER_TOPIC)
        return out
    if page is not None:
        add(R.PAGE_TOPIC)
        add(R.DISPLAY_TOPIC, sum(d is not None for d in rec.get("displays", [])))
        add(R.ACTION_TOPIC, len(rec.get("actions", [])))
    if "start" in rec:
        add(R.START_TOPIC)
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(records=st.lists(record_st, min_size=1, max_size=25))
def test_log_routing_matches_model(spark, records):
    import json
    want = {}
    for rec in records:
        for k, v in _model(rec).items():
            want[k] = want.get(k, 0) + v
    msgs = log_split.route_messages(parse_log(envelopes(spark, [json.dumps(r) for r in records])))
    got = {r.topic: r.messages for r in log_split.topic_counts(msgs).collect()}
    assert got == want


# ---------------------------------------------------------------- change split

from daystream.operators import cdc  # noqa: E402
from daystream.sources.envelopes import ROUTING, routing_table  # noqa: E402

change_st = st.tuples(
    st.sampled_from(["bootstrap-insert", "insert", "update", "delete", "bootstrap-start",
                     "INSERT"]),
    st.sampled_from(["order_info", "user_info", "base_province", "sku_info"]),
    st.integers(0, 4))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(changes=st.lists(change_st, min_size=1, max_size=30))
def test_change_split_matches_model(spark, changes):
    import json
    ops = {"bootstrap-insert": "I", "insert": "I", "update": "U", "delete": "D"}
    facts = {t for t, k in ROUTING if k == "fact"}
    dims = {t for t, k in ROUTING if k == "dim"}
    want_topics, want_dims = {}, {}
    for n, (typ, table, key) in enumerate(changes):
        op = ops.get(typ)
        if op is None:
            continue
        if table in facts:
            t = f"DWD_{table.upper()}_{op}_{R.TOPIC_SUFFIX}"
            want_topics[t] = want_topics.get(t, 0) + 1
        if table in dims:
            want_dims[(table, str(key))] = n       # last write (arrival) wins
    vals = [json.dumps({"type": t, "table": tb, "data": {"id": k, "n": n}})
            for n, (t, tb, k) in enumerate(changes)]
    parsed = cdc.with_op(cdc.parse_changes(envelopes(spark, vals, topic="ODS_BASE_DB")))
    routing = routing_table(spark)
    got_topics = {r.topic: r["count"] for r in cdc.fact_route(parsed, routing)
                  .groupBy("topic").count().collect()}
    got_dims = {(r.table, r.id): json.loads(r.data)["n"]
                for r in cdc.dim_latest(cdc.dim_changes(parsed, routing)).collect()}
    assert got_topics == want_topics
    assert got_dims == want_dims
