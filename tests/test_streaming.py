"""Streaming forms: stream result equals batch result, restart and replay
change nothing, routing changes apply between batches."""

import os

from pyspark.sql import functions as F

from daystream import schemas
from daystream.functions.routing import PAGE_TOPIC
from daystream.operators import cdc, dau, log_split
from daystream.operators.parse import parse_log
from daystream.plans import jobs
from daystream.session import scratch_path
from daystream.sinks import dim_index
from daystream.sinks.upsert import read_table
from daystream.sources.envelopes import (change_envelopes_from, log_envelopes_from,
                                         routing_table)
from daystream.streaming import jobs as sjobs
from daystream.streaming.first_seen import seen_state

SF = "/root/testdata/sf0.001"
AVAILABLE_NOW = {"availableNow": True}


def _day_files(spark, env, root, day_col="timestamp"):
    """Writes envelopes as one file folder per day (arrival order)."""
    (env.withColumn("_d", F.date_format(day_col, "yyyyMMdd"))
     .repartition(1, "_d").write.partitionBy("_d").parquet(root))
    return sorted(os.listdir(root))


def _feed(spark, env, src, stage):
    """Moves day folders into the stream source one at a time."""
    days = [d for d in _day_files(spark, env, stage) if d.startswith("_d=")]
    for d in days:
        df = spark.read.schema(schemas.ENVELOPE).parquet(os.path.join(stage, d))
        df.write.mode("append").parquet(src)
        yield d


def test_log_split_stream_equals_batch(spark):
    env = log_envelopes_from(spark, SF)
    src, out, ck = (scratch_path(spark, n) for n in ("src", "out", "ck"))
    stage = scratch_path(spark, "stage")
    days = list(_feed(spark, env, src, stage))
    assert len(days) == 30
    q = sjobs.start_log_split(sjobs.envelope_stream(spark, src, max_files_per_trigger=4),
                              out, ck, trigger=AVAILABLE_NOW)
    q.awaitTermination(300)
    msgs = spark.read.parquet(os.path.join(out, "topics"))
    got = {r.topic: r["count"] for r in msgs.groupBy("topic").count().collect()}
    want = {r.topic: r.messages for r in
            log_split.topic_counts(log_split.route_messages(parse_log(env))).collect()}
    assert got == want
    # restart from the checkpoint: nothing new, nothing duplicated
    q2 = sjobs.start_log_split(sjobs.envelope_stream(spark, src), out, ck,
                               trigger=AVAILABLE_NOW)
    q2.awaitTermination(300)
    assert spark.read.parquet(os.path.join(out, "topics")).count() == sum(want.values())
    led = jobs.read_ledger(spark, os.path.join(out, "ledger"))
    ends = {r.partition: r.until_offset for r in led.collect()}
    full = {r.partition: r.m for r in env.groupBy("partition")
            .agg((F.max("offset") + 1).alias("m")).collect()}
    assert ends == full


def _dims(spark, out):
    env = change_envelopes_from(spark, SF, tables=("user_info", "base_province"))
    jobs.process_change_batch(spark, env, out, 0)
    return os.path.join(out, "dims")


def test_change_split_stream_routing_change(spark):
    env = change_envelopes_from(spark, SF, tables=("order_info", "sku_info"))
    src, out, ck = (scratch_path(spark, n) for n in ("csrc", "cout", "cck"))
    env.where("partition < 2").write.parquet(src + "/a")
    calls = []

    def loader(s):
        calls.append(1)
        rows = [("order_info", "fact")] if len(calls) == 1 else [("sku_info", "fact")]
        return routing_table(s, rows)

    stream = spark.readStream.schema(schemas.ENVELOPE).option("recursiveFileLookup", "true")\
        .parquet(src)
    q = sjobs.start_change_split(stream, out, ck, routing_loader=loader, trigger=AVAILABLE_NOW)
    q.awaitTermination(300)
    env.where("partition >= 2").write.parquet(src + "/b")
    q = sjobs.start_change_split(stream, out, ck, routing_loader=loader, trigger=AVAILABLE_NOW)
    q.awaitTermination(300)
    topics = {r.topic for r in spark.read.parquet(os.path.join(out, "topics"))
              .select("topic").distinct().collect()}
    assert any("ORDER_INFO" in t for t in topics) and any("SKU_INFO" in t for t in topics)


def _page_messages(spark):
    pages = log_split.page_log(parse_log(log_envelopes_from(spark, SF)), with_position=True)
    return pages.select(
        F.lit(None).cast("string").alias("key"),
        F.to_json(F.struct(*schemas.PAGE_LOG.names)).alias("value"),
        F.lit(PAGE_TOPIC).alias("topic"), F.col("src_partition").alias("partition"),
        F.col("src_offset").alias("offset"), F.timestamp_millis("ts").alias("timestamp"))


def _batch_dau(spark, dims_path):
    pages = log_split.page_log(parse_log(log_envelopes_from(spark, SF)), with_position=True)
    first = dau.first_seen(dau.session_first_pages(pages), tz="UTC")
    dims = jobs.read_dims(spark, dims_path)
    return dau.dau_info(first, cdc.user_dim(dims), cdc.province_dim(dims), as_of="2024-01-31",
                        tz="UTC")


def _run_dau(spark, mode, index=None):
    dims_path = _dims(spark, scratch_path(spark, "dimsout"))
    if index:
        assert dim_index.fold(spark, dims_path, index) > 0
    src, ck, sink = (scratch_path(spark, n) for n in ("psrc", "pck", "dau"))
    stage = scratch_path(spark, "pstage")
    list(_feed(spark, _page_messages(spark), src, stage))
    stream = sjobs.page_records(sjobs.envelope_stream(spark, src, max_files_per_trigger=5))
    q = sjobs.start_dau(stream, dims_path, sink, ck, trigger=AVAILABLE_NOW, as_of="2024-01-31",
                        tz="UTC", mode=mode, watermark="40 days", dims_index=index)
    q.awaitTermination(300)
    return q, dims_path, sink, src, ck


def test_dau_stream_sink_mode_equals_batch(spark):
    q, dims_path, sink, src, ck = _run_dau(spark, "sink")
    got = read_table(spark, sink, schemas.DAU_INFO)
    want = _batch_dau(spark, dims_path)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    metrics = [p["observedMetrics"].get("dau_funnel") for p in q.recentProgress
               if p.get("observedMetrics")]
    assert sum(int(m["pages"]) for m in metrics if m) == 598
    # replaying every file as new data (a lost checkpoint) changes nothing
    stream = sjobs.page_records(sjobs.envelope_stream(spark, src))
    q2 = sjobs.start_dau(stream, dims_path, sink, scratch_path(spark, "pck2"),
                         trigger=AVAILABLE_NOW, as_of="2024-01-31", tz="UTC")
    q2.awaitTermination(300)
    again = read_table(spark, sink, schemas.DAU_INFO)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, want.collect()))


def test_dau_stream_state_mode_equals_batch(spark):
    """Whole records, the dimensions looked up in the index."""
    _, dims_path, sink, _, _ = _run_dau(spark, "state", scratch_path(spark, "dimsindex"))
    got = read_table(spark, sink, schemas.DAU_INFO)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, _batch_dau(spark, dims_path).collect()))


DAY = 86_400_000
BASE = 1704067200000  # 2024-01-01


def _msgs(spark, rows, off0):
    import json as _json
    out = []
    for n, (mid, ts, page) in enumerate(rows):
        rec = {"mid": mid, "user_id": "1", "province_id": "1", "page_id": page, "during_time": None, "ts": ts}
        out.append((None, _json.dumps(rec), PAGE_TOPIC, 0, off0 + n, None))
    return spark.createDataFrame(out, schemas.ENVELOPE).coalesce(1)


def _dau_batches(spark, batches, mode, ck=None, sink=None, watermark="1 day"):
    """Each batch arrives and is read by a restart of the query."""
    dims_path = _dims(spark, scratch_path(spark, "late-dims"))
    src, ck, sink = scratch_path(spark, "lsrc"), ck or scratch_path(spark, "lck"), sink or scratch_path(spark, "lsink")
    for b in batches:
        b.write.mode("append").parquet(src)
        stream = sjobs.page_records(sjobs.envelope_stream(spark, src))
        sjobs.start_dau(stream, dims_path, sink, ck, trigger=AVAILABLE_NOW, tz="UTC", mode=mode,
                        watermark=watermark).awaitTermination(120)
    return {(r.dt, r.mid, r.page_id) for r in read_table(spark, sink, schemas.DAU_INFO).collect()}, ck, sink


def test_late_rows_are_kept_in_both_modes(spark):
    """Rows months old join their own day; a device counted there isn't counted again."""
    old = BASE - 200 * DAY
    batches = [_msgs(spark, [("a", BASE + 1000, "p")], 0),
               _msgs(spark, [("b", BASE + 5 * DAY + 1000, "p"), ("o", old, "p")], 10),
               _msgs(spark, [("c", BASE + DAY + 5, "p"), ("b", BASE + 5 * DAY + 9, "q"), ("o", old + 5, "q"), ("n", old, "r"), ("n", old + 1, "s")], 20),
               _msgs(spark, [("a", BASE + 7, "late"), ("n", old + 9, "t"), ("d", BASE + 5 * DAY, "p")], 30)]
    want = {("2024-01-01", "a", "p"), ("2024-01-06", "b", "p"), ("2024-01-02", "c", "p"), ("2023-06-15", "o", "p"),
            ("2023-06-15", "n", "r"), ("2024-01-06", "d", "p")}
    for mode in ("sink", "state"):
        got, ck, _ = _dau_batches(spark, batches, mode)
        assert got == want
    # the state holds the days within the watermark, the others have ended
    assert {(r.dt, r.mid) for r in seen_state(spark, ck).collect()} == {("2024-01-06", "b"), ("2024-01-06", "d")}


def test_state_keeps_the_earliest_page_of_a_batch(spark):
    rows = [("a", BASE + 9, "third"), ("a", BASE + 3, "first"), ("a", BASE + 3, "second"), ("b", BASE + 5, "x")]
    assert _dau_batches(spark, [_msgs(spark, rows, 0)], "state")[0] == {("2024-01-01", "a", "first"), ("2024-01-01", "b", "x")}


def test_lost_checkpoint_starts_with_the_stored_keys(spark, monkeypatch):
    """A new checkpoint: the stored keys are its state, no stored day is read by its batches."""
    first = [_msgs(spark, [("a", BASE, "p"), ("b", BASE + 2 * DAY, "p")], 0)]
    want, _, sink = _dau_batches(spark, first, "state")
    checked = []
    monkeypatch.setattr(dau, "new_only", lambda c, s, f=dau.new_only: checked.append(c.count()) or f(c, s))
    again = [_msgs(spark, [("b", BASE + 2 * DAY + 5, "again"), ("c", BASE + 2 * DAY, "p")], 0)]
    got, ck, _ = _dau_batches(spark, again, "state", sink=sink, watermark="3 days")
    assert got == want | {("2024-01-03", "c", "p")} and checked == []
    assert {(r.dt, r.mid) for r in seen_state(spark, ck).collect()} == {(d, m) for d, m, _ in got}
    # a shorter memory leaves day 1 to the stored result
    got, ck, _ = _dau_batches(spark, [_msgs(spark, [("a", BASE + 5, "again"), ("b", BASE + 2 * DAY, "again")], 0)], "state", sink=sink)
    assert got == want | {("2024-01-03", "c", "p")} and checked == [1]
    assert {(r.dt, r.mid) for r in seen_state(spark, ck).collect()} == {("2024-01-03", "b"), ("2024-01-03", "c")}


def test_state_mode_brings_its_own_state_store(spark):
    """A session with the engine's default store, which has no timers, and none of its settings changed after."""
    key = "spark.sql.streaming.stateStore.providerClass"
    own = spark.conf.get(key)
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(key, default)
    try:
        batches = [_msgs(spark, [("a", BASE + 9, "later"), ("a", BASE + 3, "first")], 0), _msgs(spark, [("a", BASE + 1, "late")], 10)]
        got, ck, _ = _dau_batches(spark, batches, "state")
        assert got == {("2024-01-01", "a", "first")}
        assert [(r.mid, r.ts) for r in seen_state(spark, ck).collect()] == [("a", BASE + 3)]
        assert spark.conf.get(key) == default
    finally:
        spark.conf.set(key, own)


def test_state_processor_travels_with_its_code(tmp_path):
    """The process that starts it has none of the files that a session sends to its workers."""
    import subprocess
    import sys
    from pyspark import cloudpickle
    from daystream.streaming.first_seen import FirstSeen
    (tmp_path / "p").write_bytes(cloudpickle.dumps(FirstSeen(["mid"])))
    code = ("import sys; from pyspark import cloudpickle; p = cloudpickle.loads(open('p', 'rb').read()); "
            "assert p.columns == ['mid'] and not any(m.startswith('daystream') for m in sys.modules)")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True, timeout=120)


def test_supervise_restarts_and_stops(spark, tmp_path):
    """Two queries with a processing-time trigger: one fails once, then a marker stops both."""
    import threading
    import time
    src, marker = scratch_path(spark, "sup-src"), str(tmp_path / "stop")
    _msgs(spark, [("a", BASE, "p")], 0).write.parquet(src)
    counts = {"good": 0, "bad": 0}

    def starter(name):
        def each(batch, batch_id):
            if name == "bad" and counts["bad"] == 0:
                counts["bad"] = 1
                raise ValueError("once")
            counts[name] += batch.count()

        return lambda: (sjobs.envelope_stream(spark, src).writeStream.foreachBatch(each).option("checkpointLocation", str(tmp_path / name))
                        .trigger(processingTime="1 second").start())

    def stop():
        until = time.time() + 90
        while time.time() < until and (counts["good"] < 1 or counts["bad"] < 2):
            time.sleep(.5)
        open(marker, "w").close()

    threading.Thread(target=stop, daemon=True).start()
    restarts = sjobs.supervise(spark, {"good": starter("good"), "bad": starter("bad")}, marker, poll_s=1)
    assert restarts == {"good": 0, "bad": 1} and counts == {"good": 1, "bad": 2}
    assert not spark.streams.active
