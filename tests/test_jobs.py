"""The jobs around the operators: runs and replays, dead letters, the dimension
store, staging, resume positions."""

import json
import os

from messages import envelopes
from pyspark.sql import functions as F

from daystream import schemas
from daystream.functions.routing import DEAD_LETTER_TOPIC, PAGE_TOPIC
from daystream.operators import cdc
from daystream.operators.parse import page_dead_letter, parse_log, parse_page_messages
from daystream.plans import jobs
from daystream.session import checkpoint_root, scratch_path
from daystream.sinks import dims, seen_index
from daystream.sinks.upsert import list_folders, read_table
from daystream.sources.envelopes import routing_table, stored_routing
from daystream.sources.kafka import start_position
from daystream.streaming import jobs as sjobs

NOW = {"availableNow": True}


def change(t, table, data):
    return json.dumps({"type": t, "table": table, "data": data})


def topics(spark, out):
    return {r.topic: r["count"] for r in spark.read.parquet(f"{out}/topics").groupBy("topic").count().collect()}


def test_change_split_reads_and_parses_its_source_once(spark):
    for persist in (False, True):
        read = {c: spark.sparkContext.accumulator(0) for c in ("value", "offset")}

        def counted(name, kind):
            def count(v):
                read[name].add(1)
                return v
            return F.udf(count, kind)(name).alias(name)

        env = envelopes(spark, [change("insert", "order_info", {"id": 1}), change("update", "user_info", {"id": 2}),
                                change("insert", "user_info", {}), change("bootstrap-start", "order_info", None), "broken"])
        env = env.select("key", counted("value", "string"), "topic", "partition", counted("offset", "bigint"), "timestamp")
        out = scratch_path(spark, "once")
        jobs.process_change_batch(spark, env, out, 0, persist=persist)
        assert {c: a.value for c, a in read.items()} == {"value": 5, "offset": 5}
        assert topics(spark, out) == {"DWD_ORDER_INFO_I_20220629": 1, DEAD_LETTER_TOPIC: 2}
        assert [r.id for r in dims.read_dims(spark, f"{out}/dims").collect()] == ["2"]
        assert [r.until_offset for r in jobs.read_ledger(spark, f"{out}/ledger").collect()] == [5]


def test_dau_batches_with_the_index_of_stored_devices(spark):
    plain, indexed, index = (scratch_path(spark, n) for n in ("dau", "dau", "dau-seen"))
    at = 1704067200000  # 2024-01-01 UTC
    none = spark.createDataFrame([], dims.DIM_SCHEMA)
    for b in range(4):
        pages = spark.createDataFrame([(f"m{i % 7}", None, at + 1000 * i + 43_200_000 * b, 0, 100 * b + i) for i in range(5 + b)],
                                      "mid string, last_page_id string, ts long, src_partition int, src_offset long")
        pages = pages.select(*[F.col(n) if n in pages.columns else F.lit(None).cast(schemas.PAGE_LOG[n].dataType).alias(n)
                               for n in schemas.PAGE_LOG.names], "src_partition", "src_offset")
        for path, kw in ((plain, {}), (indexed, {"seen_index": index})):
            for _ in range(2):  # and its replay
                jobs.process_page_batch(spark, pages, none, path, tz="UTC", **kw)
        if b == 1:
            assert seen_index.fold_seen(spark, indexed, index) > 0

    def table(path):
        return sorted((r.dt, r.mid, r.ts) for r in read_table(spark, path, schemas.DAU_INFO).collect())
    assert table(indexed) == table(plain) and len({r[:2] for r in table(plain)}) == len(table(plain)) > 7


def test_replay_with_changed_routing_leaves_no_old_topic(spark):
    out = scratch_path(spark, "routing-replay")
    env = envelopes(spark, [change("insert", "order_info", {"id": 1}), change("insert", "sku_info", {"id": 2})], topic="ODS_BASE_DB")
    jobs.process_change_batch(spark, env, out, 0, routing=routing_table(spark, [("order_info", "fact")]))
    assert list(topics(spark, out)) == ["DWD_ORDER_INFO_I_20220629"]
    jobs.process_change_batch(spark, env, out, 0, routing=routing_table(spark, [("sku_info", "fact")]))
    assert list(topics(spark, out)) == ["DWD_SKU_INFO_I_20220629"]


def test_a_new_run_adds_to_the_output(spark):
    out = scratch_path(spark, "runs")
    for _ in range(2):
        jobs.log_split_job(spark, "/root/testdata/sf0.001", out)
    n = sum(topics(spark, out).values())
    jobs.log_split_job(spark, "/root/testdata/sf0.001", out, run_id="mine")
    jobs.log_split_job(spark, "/root/testdata/sf0.001", out, run_id="mine")
    assert sum(topics(spark, out).values()) == n * 3 // 2


def test_change_dead_letters_and_null_ids(spark):
    out = scratch_path(spark, "cdc-dead")
    bad = ["", "\t\n", "{", '[1]', "{}", json.dumps({"table": "user_info", "data": {"id": 1}}),
           json.dumps({"type": "insert", "table": "order_info"}), change("update", "user_info", {"gender": "M"})]
    good = [change("insert", "user_info", {"id": 1}), change("bootstrap-start", "user_info", {}), change("insert", "unlisted", {})]
    env = envelopes(spark, bad + good, topic="ODS_BASE_DB")
    dead = cdc.change_dead_letter(cdc.parse_changes(env), routing_table(spark)).orderBy("src_offset").collect()
    assert [r.reason for r in dead] == ["empty", "empty", "corrupt", "corrupt", "missing_table", "missing_type", "missing_data", "missing_id"]
    for b in range(3):
        jobs.process_change_batch(spark, env, out, b, persist=b == 1)
    assert topics(spark, out) == {DEAD_LETTER_TOPIC: 3 * 8}
    stored = jobs.read_dims(spark, f"{out}/dims").collect()
    assert [(r.table, r.id) for r in stored] == [("user_info", "1")]


def test_page_dead_letters_never_count(spark):
    rec = {"mid": "a", "ts": 1704067200000, "page_id": "p", "user_id": "1"}
    vals = ["not json", None, "  ", json.dumps({**rec, "mid": None}), json.dumps({**rec, "ts": "x"}), json.dumps(rec), json.dumps({**rec, "mid": "b"})]
    env = envelopes(spark, vals, topic=PAGE_TOPIC)
    assert [r.reason for r in page_dead_letter(env).orderBy("src_offset").collect()] == ["corrupt", "empty", "empty", "missing_mid", "missing_ts"]
    assert sorted(r.mid for r in parse_page_messages(env).collect()) == ["a", "b"]
    out, no_dims = scratch_path(spark, "pages"), jobs.read_dims(spark, scratch_path(spark, "none"))
    for b in range(2):
        jobs.process_page_messages(spark, env, no_dims, out, b, tz="UTC")
    rows = read_table(spark, f"{out}/dau", schemas.DAU_INFO).collect()
    assert sorted((r.dt, r.mid) for r in rows) == [("2024-01-01", "a"), ("2024-01-01", "b")]
    led = jobs.read_ledger(spark, f"{out}/ledger").collect()
    assert [(r.group_id, r.topic, r.until_offset, r.batch_id) for r in led] == [("dwd_dau", PAGE_TOPIC, 7, 1)]


def test_required_longs_of_log_records(spark):
    common = {"mid": "m"}
    vals = [json.dumps({"common": common, "ts": 1, "start": {"entry": "x"}}),
            json.dumps({"common": common, "ts": 1, "page": {"during_time": 1}, "actions": [{"action_id": "a", "ts": "soon"}]}),
            json.dumps({"common": common, "ts": 1, "page": {"during_time": 1}, "actions": [None, {"ts": 2}]}), "\t\n"]
    got = [r.dead_reason for r in parse_log(envelopes(spark, vals)).orderBy("src_offset").collect()]
    assert got == ["missing_loading_time", "missing_action_ts", None, "empty"]


def test_a_small_change_leaves_stored_files_alone(spark):
    out = scratch_path(spark, "dim-files")

    def batch(keys, n, value):
        env = envelopes(spark, [change("insert", "user_info", {"id": k, "v": value}) for k in keys], topic="ODS_BASE_DB", start_offset=n * 1000)
        jobs.process_change_batch(spark, env, out, n, run_id="r")

    def files():
        return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(f"{out}/dims") for f in fs if f.endswith(".parquet")}
    batch(range(500), 0, 0)
    before = files()
    batch(range(5), 1, 1)
    assert before.items() <= files().items() and len(files()) > len(before)
    rows = {r.id: json.loads(r.data)["v"] for r in jobs.read_dims(spark, f"{out}/dims").collect()}
    assert len(rows) == 500 and sum(rows.values()) == 5
    old = dims.compact_dims(spark, f"{out}/dims")
    same = {r.id: json.loads(r.data)["v"] for r in jobs.read_dims(spark, f"{out}/dims").collect()}
    dims.drop_compacted(spark, old)
    assert rows == same == {r.id: json.loads(r.data)["v"] for r in jobs.read_dims(spark, f"{out}/dims").collect()}
    batch(range(2), 2, 7)
    assert {r.id for r in jobs.read_dims(spark, f"{out}/dims").collect() if json.loads(r.data)["v"] == 7} == {"0", "1"}


def test_message_key_and_routing_from_a_table(spark):
    out, table = scratch_path(spark, "keyed"), scratch_path(spark, "routing")
    routing_table(spark, [("order_info", "fact")]).write.parquet(table)
    env = envelopes(spark, [change("insert", "order_info", {"id": 5}), change("insert", "sku_info", {"id": 6})], topic="ODS_BASE_DB")
    src, ck = scratch_path(spark, "keyed-src"), scratch_path(spark, "keyed-ck")
    load = stored_routing(table)
    for n in range(2):
        env.withColumn("offset", F.col("offset") + 10 * n).write.mode("append").parquet(src)
        sjobs.start_change_split(sjobs.envelope_stream(spark, src), out, ck, routing_loader=load, trigger=NOW, key="id").awaitTermination()
        routing_table(spark, [("sku_info", "fact")]).write.mode("overwrite").parquet(table)
    got = sorted((r.topic, r.key) for r in spark.read.parquet(f"{out}/topics").collect())
    assert got == [("DWD_ORDER_INFO_I_20220629", "5"), ("DWD_SKU_INFO_I_20220629", "6")]


def test_start_position_both_ways(spark):
    path = scratch_path(spark, "positions")
    assert start_position(jobs.read_ledger(spark, path), "g", "T") == "latest"
    assert start_position(None, "g", "T", "earliest") == "earliest"
    for off in (40, 3):     # the later save counts, also if it is lower
        jobs.save_ledger(spark, path, envelopes(spark, ["x"], topic="T", start_offset=off), "g", 0)
    assert json.loads(start_position(jobs.read_ledger(spark, path), "g", "T")) == {"T": {"0": 4}}


def test_nothing_is_left_staged(spark):
    out, root = scratch_path(spark, "clean"), checkpoint_root(spark)
    rec = {"mid": "a", "ts": 1704067200000, "page_id": "p"}
    env = envelopes(spark, [json.dumps(rec)], topic=PAGE_TOPIC)
    before = set(list_folders(spark, root, 1))
    for b in range(3):
        jobs.process_page_messages(spark, env, jobs.read_dims(spark, f"{out}/dims"), out, b, tz="UTC")
    assert {os.path.basename(f) for f in set(list_folders(spark, root, 1)) - before} <= {os.path.basename(out)}


def test_state_mode_keeps_the_stored_row_after_a_lost_checkpoint(spark):
    rec = {"mid": "a", "ts": 1704067200000, "page_id": "first", "user_id": "1", "during_time": 1}
    sink, none = scratch_path(spark, "state-dau"), scratch_path(spark, "state-dims")
    for n in range(2):
        src = scratch_path(spark, "state-src")
        late = {**rec, "page_id": ["first", "later"][n], "ts": rec["ts"] + n}
        envelopes(spark, [json.dumps(late)], topic=PAGE_TOPIC, start_offset=n).write.parquet(src)
        sjobs.start_dau(sjobs.page_records(sjobs.envelope_stream(spark, src)), none, sink, scratch_path(spark, "state-ck"),
                        trigger=NOW, tz="UTC", mode="state").awaitTermination()
    assert [(r.mid, r.page_id) for r in read_table(spark, sink, schemas.DAU_INFO).collect()] == [("a", "first")]
