"""Registered queries: one ``(spark, sf_dir) -> DataFrame`` per operator.

Each query derives its message envelopes from the provided tables with
Spark (``daystream.sources.envelopes``), runs the real parser and
operators over all of them, and returns typed columns. Queries that
exercise a sink write to a fresh folder under the shared checkpoint root
and return what they read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daystream import schemas
from daystream.functions.dates import age_years, dt_of, hr_of
from daystream.functions import routing
from daystream.functions.routing import PAGE_TOPIC
from daystream.operators import cdc, dau, ledger, log_split
from daystream.operators.parse import (dead_letter, envelope_summary, parse_log,
                                       parse_page_messages)
from daystream.operators.project import project_like
from daystream.session import scratch_path
from daystream.sinks.upsert import read_table, stage, upsert_partitions, upsert_staged
from daystream.sources.envelopes import (LOG_TOPIC, change_envelopes_from, log_envelopes_from,
                                         routing_table)

#: Reference date for ages, so results do not depend on the day of the run.
AS_OF = "2024-01-31"
#: Zone of the calendar day / hour; pinned so results do not depend on the
#: session or machine zone.
TZ = "UTC"
#: Consumer group of the log split (fixed value, as in plans.jobs).
LOG_GROUP = "g1"
#: Split day of the two-phase scenarios (state restored from the first
#: half of the month, then the stream goes on).
SPLIT_DT = "2024-01-15"
#: Where the second phase of the restore scenario starts reading.
RESUME_DT = "2024-01-10"

_DAY_MS = 86_400_000


# ------------------------------------------------------------------ builders

def _parsed(spark, sf):
    return parse_log(log_envelopes_from(spark, sf))


def _pages(spark, sf, with_position=True):
    return log_split.page_log(_parsed(spark, sf), with_position=with_position)


def _latest_dims(spark, sf, tables=("user_info", "base_province")):
    # Only the dimension sources: the other tables' changes would be dropped
    # by the routing semi join anyway. A lookup of one table reads one source.
    env = change_envelopes_from(spark, sf, tables=tables)
    changes = cdc.with_op(cdc.parse_changes(env))
    return cdc.dim_latest(cdc.dim_changes(changes, routing_table(spark)))


def _first_seen(spark, sf):
    return dau.first_seen(dau.session_first_pages(_pages(spark, sf)), tz=TZ)


def _users(spark, sf):
    return cdc.user_dim(_latest_dims(spark, sf, ("user_info",)))


def _provinces(spark, sf):
    return cdc.province_dim(_latest_dims(spark, sf, ("base_province",)))


def _dau(spark, sf, first=None):
    first = first if first is not None else _first_seen(spark, sf)
    return dau.dau_info(first, _users(spark, sf), _provinces(spark, sf), as_of=AS_OF, tz=TZ)


def _with_batch(env: DataFrame) -> DataFrame:
    """Daily micro-batches: batch id = epoch day of the message time."""
    return env.withColumn("batch_id", F.floor(F.unix_millis("timestamp") / _DAY_MS)
                          .cast("bigint"))


def _log_ledger(spark, sf, last_dt: str | None = None):
    env = _with_batch(log_envelopes_from(spark, sf))
    if last_dt:
        env = env.where(F.col("batch_id") <= F.unix_date(F.to_date(F.lit(last_dt))))
    ranges = ledger.offset_ranges(env, "batch_id")
    return ledger.ledger_save(None, ranges, LOG_GROUP, "batch_id").drop("saved_at", "run")


# ------------------------------------------------------------------- queries

def q_parse_envelope(spark, sf):
    return envelope_summary(_parsed(spark, sf))


def q_parse_page_log(spark, sf):
    pages = _pages(spark, sf)
    msgs = pages.select(
        F.lit(None).cast("string").alias("key"),
        F.to_json(F.struct(*schemas.PAGE_LOG.names)).alias("value"),
        F.lit(PAGE_TOPIC).alias("topic"),
        F.col("src_partition").alias("partition"), F.col("src_offset").alias("offset"),
        F.timestamp_millis("ts").alias("timestamp"))
    return parse_page_messages(msgs).select(*schemas.PAGE_LOG.names)


def q_page_log(spark, sf):
    return log_split.page_log(_parsed(spark, sf))


def q_display_log(spark, sf):
    return log_split.display_log(_parsed(spark, sf))


def q_action_log(spark, sf):
    return log_split.action_log(_parsed(spark, sf))


def q_start_log(spark, sf):
    return log_split.start_log(_parsed(spark, sf))


def q_error_log(spark, sf):
    e = log_split.error_log(_parsed(spark, sf))
    return e.select("src_partition", "src_offset",
                    F.get_json_object("value", "$.err.error_code").alias("error_code"),
                    F.get_json_object("value", "$.common.mid").alias("mid"),
                    F.get_json_object("value", "$.ts").alias("ts_text"))


def q_dead_letter(spark, sf):
    return dead_letter(_parsed(spark, sf)).select("src_partition", "src_offset", "reason")


def q_log_route_counts(spark, sf):
    return log_split.route_counts(_parsed(spark, sf))


def q_route_all_topics(spark, sf):
    return log_split.topic_counts(log_split.route_messages(_parsed(spark, sf)))


def _changes(spark, sf):
    return cdc.parse_changes(change_envelopes_from(spark, sf))


def q_cdc_op_map(spark, sf):
    return cdc.with_op(_changes(spark, sf)).select(
        "src_partition", "src_offset", "table", "type", "op")


def q_cdc_fact_route(spark, sf):
    routed = cdc.fact_route(cdc.with_op(_changes(spark, sf)), routing_table(spark))
    return routed.select("topic", "src_partition", "src_offset",
                         F.get_json_object("value", "$.id").alias("id"))


def q_cdc_route_counts(spark, sf):
    return cdc.route_counts(_changes(spark, sf), routing_table(spark))


def q_dim_latest(spark, sf):
    return _latest_dims(spark, sf).select("table", "id", "op", "src_partition", "src_offset")


def q_session_first_pages(spark, sf):
    return dau.session_first_pages(_pages(spark, sf, with_position=False))


def q_dau_first_seen(spark, sf):
    return _first_seen(spark, sf).select(*schemas.PAGE_LOG.names, "dt")


def q_date_parts(spark, sf):
    return _pages(spark, sf).select("src_partition", "src_offset", "ts",
                                    dt_of("ts", TZ).alias("dt"), hr_of("ts", TZ).alias("hr"))


def q_user_age(spark, sf):
    users = _users(spark, sf)
    return users.select("user_id", "user_gender", "birthday",
                        age_years("birthday", AS_OF).alias("user_age"))


def q_dau_user_join(spark, sf):
    j = dau.join_user(_first_seen(spark, sf), _users(spark, sf), as_of=AS_OF)
    return j.select("dt", "mid", "user_id", "user_gender", "user_age")


def q_dau_province_join(spark, sf):
    j = dau.join_province(_first_seen(spark, sf), _provinces(spark, sf))
    return j.select("dt", "mid", "province_id", "province_name", "province_iso_code",
                    "province_3166_2", "province_area_code")


def q_dau_info(spark, sf):
    return _dau(spark, sf)


def _dau_sink(spark, sf) -> str:
    """Upserts the DAU records into a fresh table; returns its path."""
    path = scratch_path(spark, "dau")
    upsert_partitions(spark, _dau(spark, sf), path, ["dt", "mid"])
    return path


def q_dau_seen_mids(spark, sf):
    from daystream.plans.jobs import seen_devices
    return seen_devices(spark, _dau_sink(spark, sf))


def q_dau_new_only(spark, sf):
    """Restore scenario: the sink holds the days up to SPLIT_DT; the stream
    is re-read from RESUME_DT; only devices not yet counted come out. The
    first-seen pages are computed once and staged for both phases."""
    first = stage(spark, _first_seen(spark, sf), "first-seen")
    path = scratch_path(spark, "dau")
    upsert_partitions(spark, _dau(spark, sf, first=first.where(F.col("dt") <= SPLIT_DT)),
                      path, ["dt", "mid"])
    candidates = first.where(F.col("dt") >= RESUME_DT)
    # the same day predicate prunes the stored partitions statically
    seen = (read_table(spark, path, schemas.DAU_INFO).where(F.col("dt") >= RESUME_DT)
            .select("dt", "mid"))
    return _dau(spark, sf, first=dau.new_only(candidates, seen))


def q_dau_new_only_indexed(spark, sf):
    """The restore scenario against the index of stored devices: the sink is written in
    three stretches, two of them folded, the last not."""
    from daystream.sinks import seen_index
    from daystream.sinks.upsert import append_partitions
    first = stage(spark, _first_seen(spark, sf), "first-seen")
    path, index = scratch_path(spark, "dau"), scratch_path(spark, "dau-index")
    stored = stage(spark, _dau(spark, sf, first=first.where(F.col("dt") <= SPLIT_DT)), "dau-stored")
    slot = F.pmod(F.xxhash64("mid"), F.lit(3))
    for i in range(3):
        append_partitions(stored.where(slot == i), path)
        if i < 2:
            seen_index.fold_seen(spark, path, index)
    candidates = first.where(F.col("dt") >= RESUME_DT)
    return _dau(spark, sf, first=dau.new_only(candidates, seen_index.seen_keys(spark, path, index, candidates)))


def q_dau_upsert(spark, sf):
    """First half of the month, then the whole month twice: the table must
    hold each (dt, mid) once. The month's records are computed once and
    staged; the three upserts read the staged copy."""
    path = scratch_path(spark, "dau")
    whole = stage(spark, _dau(spark, sf), "dau-month")
    upsert_staged(spark, whole.where(F.col("dt") <= SPLIT_DT), path, ["dt", "mid"])
    upsert_staged(spark, whole, path, ["dt", "mid"])
    upsert_staged(spark, whole, path, ["dt", "mid"])
    return read_table(spark, path, schemas.DAU_INFO)


def q_dau_funnel_counts(spark, sf):
    return dau.funnel_counts(_pages(spark, sf), users=_users(spark, sf),
                             provinces=_provinces(spark, sf), tz=TZ)


def q_project_by_name(spark, sf):
    return project_like(_pages(spark, sf, with_position=False), schemas.DAU_INFO)


def q_offset_ranges(spark, sf):
    return ledger.offset_ranges(_with_batch(log_envelopes_from(spark, sf)), "batch_id")


def q_offset_ledger_save(spark, sf):
    return _log_ledger(spark, sf)


def q_offset_ledger_read(spark, sf):
    return ledger.ledger_read(_log_ledger(spark, sf), LOG_GROUP, LOG_TOPIC)


def q_read_from_offsets(spark, sf):
    # staged, as a stored ledger would be: the scan feeds it once
    saved = stage(spark, _log_ledger(spark, sf, SPLIT_DT), "ledger")
    rest = ledger.read_from_offsets(log_envelopes_from(spark, sf), saved, LOG_GROUP, LOG_TOPIC)
    return rest.select("partition", "offset")


def _arrive_in_slices(spark, df: DataFrame, src: str, run_stream, slices: int = 3, keep: bool = True) -> None:
    """Lets ``df`` (envelopes with a ``timestamp``) arrive in time order, in
    ``slices`` equal stretches of its time span: each is written as new files
    (by the tasks that hold its rows, without a shuffle)
    and the stream then catches up (``availableNow``) before the next one
    arrives, as a live stream would. ``df`` is staged once first; without ``keep``
    each stretch is made from its tables, for rows that cost less to make than to copy."""
    rows = stage(spark, df, "arrivals") if keep else df
    ms = F.unix_millis("timestamp")
    lo, hi = rows.agg(F.min(ms), F.max(ms)).first()
    if lo is None:
        lo = hi = 0
    step = (hi - lo) // slices + 1
    for k in range(slices):
        rows.where(F.floor((ms - lo) / step) == k).write.parquet(f"{src}/slice={k}")
        run_stream()


def q_stream_route_counts(spark, sf):
    """The log split as a stream: envelopes arrive in time slices, each
    processed by a restart of the query from its checkpoint; the messages
    it wrote are counted per topic."""
    from daystream.streaming import jobs as sjobs
    src, out, ck = (scratch_path(spark, n) for n in ("s-log", "s-log-out", "s-log-ck"))

    def run():
        sjobs.start_log_split(_stream_of(spark, src), out, ck,
                              trigger={"availableNow": True}).awaitTermination()

    _arrive_in_slices(spark, log_envelopes_from(spark, sf), src, run)
    written = spark.read.parquet(f"{out}/topics")
    return written.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))


def q_stream_dau_info(spark, sf):
    """The DAU job as a stream: dimensions from a change-split batch, page
    messages arriving in time slices, the result table read back."""
    from daystream.plans import jobs
    from daystream.streaming import jobs as sjobs
    dims_out = scratch_path(spark, "s-dims")
    jobs.process_change_batch(spark, change_envelopes_from(
        spark, sf, tables=("user_info", "base_province")), dims_out, 0)
    src, sink, ck = (scratch_path(spark, n) for n in ("s-pages", "s-dau", "s-dau-ck"))

    def run():
        stream = sjobs.page_records(_stream_of(spark, src))
        sjobs.start_dau(stream, f"{dims_out}/dims", sink, ck, trigger={"availableNow": True},
                        as_of=AS_OF, tz=TZ).awaitTermination()

    _arrive_in_slices(spark, _page_messages(spark, sf), src, run)
    return read_table(spark, sink, schemas.DAU_INFO)


def _stream_of(spark, src):
    return (spark.readStream.schema(schemas.ENVELOPE)
            .option("recursiveFileLookup", "true").parquet(src))


def _page_messages(spark, sf):
    """Page-topic messages of all page records; every 97th record is broken in
    one of four ways and sent again right after it, so the dead letters are
    known and the records are all there. Offsets rise with time: a record's
    are 2n, a broken one's 2n + 1."""
    from daystream.plans.jobs import page_messages
    pages = page_messages(_pages(spark, sf))
    n = F.col("offset") * 4 + F.col("partition")
    good = pages.withColumn("offset", F.col("offset") * 2)
    broken = F.element_at(F.array(
        F.lit("not json"), F.lit(" "),
        F.to_json(F.struct(F.lit("v").alias("page_id"), F.lit(1).alias("ts"))),
        F.to_json(F.struct(F.lit("m").alias("mid"), F.lit("soon").alias("ts")))),
        (F.floor(n / 97) % 4 + 1).cast("int"))
    bad = pages.where(n % 97 == 0).withColumn("value", broken).withColumn("offset", F.col("offset") * 2 + 1)
    return good.unionByName(bad)


def q_page_dead_letter(spark, sf):
    from daystream.operators.parse import page_dead_letter
    return page_dead_letter(_page_messages(spark, sf)).select("src_partition", "src_offset", "reason")


def _changes_with_garbage(spark, sf):
    """All change messages at even offsets, and for every 97th position one broken
    copy at the odd offset after it."""
    env = change_envelopes_from(spark, sf)
    broken = F.element_at(F.array(
        F.lit("{"), F.lit("\t\n"), F.lit('{"type":"insert","data":{"id":1}}'),
        F.lit('{"table":"user_info","data":{"id":1}}'),
        F.lit('{"type":"insert","table":"order_info"}'),
        F.lit('{"type":"update","table":"user_info","data":{"gender":"M"}}')),
        (F.floor(F.col("offset") / 97) % 6 + 1).cast("int"))
    bad = env.where(F.col("offset") % 97 == 0).withColumn("value", broken).withColumn("offset", F.col("offset") * 2 + 1)
    return env.withColumn("offset", F.col("offset") * 2).unionByName(bad)


def q_cdc_dead_letter(spark, sf):
    changes = cdc.parse_changes(_changes_with_garbage(spark, sf))
    return cdc.change_dead_letter(changes, routing_table(spark)).select(
        "src_partition", "src_offset", "reason")


def _halves(df):
    odd = F.floor(F.col("offset") / 2) % 2 == 1
    return df.where(~odd), df.where(odd)


def q_stream_log_restart(spark, sf):
    """Half of the log, then the other half by a query with a new checkpoint and
    the same output folder: nothing of the first half may be lost."""
    from daystream.streaming import jobs as sjobs
    out = scratch_path(spark, "r-log")
    for i, half in enumerate(_halves(log_envelopes_from(spark, sf))):
        src, ck = scratch_path(spark, f"r-log-src{i}"), scratch_path(spark, f"r-log-ck{i}")
        half.write.parquet(src)
        sjobs.start_log_split(_stream_of(spark, src), out, ck,
                              trigger={"availableNow": True}).awaitTermination()
    return spark.read.parquet(f"{out}/topics").groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))


def q_ledger_restart(spark, sf):
    """Five saves, one per stretch of the log, then a new run whose batch 0 saves
    the whole log: that one is the position, whatever its number."""
    from daystream.plans import jobs
    path = scratch_path(spark, "r-ledger")
    env = stage(spark, log_envelopes_from(spark, sf).select("topic", "partition", "offset"), "log-positions")
    for b in range(5):
        jobs.save_ledger(spark, path, env.where(F.col("offset") % 16 <= b), LOG_GROUP, b)
    jobs.save_ledger(spark, path, env, LOG_GROUP, 0)
    return jobs.read_ledger(spark, path).select("group_id", "topic", "partition", "until_offset", "batch_id")


def q_dim_store_batches(spark, sf):
    """The dimension changes in three batches by message order, the last one
    replayed, deletes as tombstones, a compaction in between."""
    from daystream.plans import jobs
    from daystream.sinks import dims
    out, run = scratch_path(spark, "d-store"), jobs.new_run()
    env = stage(spark, change_envelopes_from(spark, sf, tables=("user_info", "base_province")), "dim-changes")
    slot = F.col("offset") % 16
    parts = [env.where(slot.isin(6, 8)), env.where((slot == 7) & (F.col("partition") < 2)),
             env.where((slot == 9) | ((slot == 7) & (F.col("partition") >= 2)))]
    for b, part in enumerate(parts):
        jobs.process_change_batch(spark, part, out, b, on_delete="drop", run_id=run)
        if b == 1:
            dims.drop_compacted(spark, dims.compact_dims(spark, f"{out}/dims"))
    jobs.process_change_batch(spark, parts[2], out, 2, on_delete="drop", run_id=run)
    return jobs.read_dims(spark, f"{out}/dims").select("table", "id", "op", "src_partition", "src_offset")


def q_dim_store_fenced(spark, sf):
    """The dimension changes in two runs: the first writes its batches, once more
    with a clock that is a day ahead, then the second one the last changes."""
    from daystream.plans import jobs
    from daystream.sinks import dims
    from daystream.sinks.fence import begin_run
    out = scratch_path(spark, "f-store")
    env = stage(spark, change_envelopes_from(spark, sf, tables=("user_info", "base_province")), "dim-changes")
    late = F.col("offset") % 16 == 9
    run = begin_run(spark, f"{out}/ledger")
    for b, part in enumerate([env.where(F.col("offset") % 16 == 6), env.where((F.col("offset") % 16).isin(7, 8))]):
        jobs.process_change_batch(spark, part, out, b, on_delete="drop", run_id="first", fence=run)
    ahead = (spark.read.schema(dims.DIM_SCHEMA).parquet(f"{out}/dims").select(*dims.DIM_COLS)
             .withColumn("saved_at", F.col("saved_at") + F.expr("interval 1 day")))
    ahead.write.partitionBy("table").parquet(f"{out}/dims/run=ahead/batch_id=0")
    jobs.process_change_batch(spark, env.where(late), out, 0, on_delete="drop", run_id="second",
                              fence=begin_run(spark, f"{out}/ledger"))
    return jobs.read_dims(spark, f"{out}/dims").select("table", "id", "op", "src_partition", "src_offset")


def q_stream_dau_state_restore(spark, sf):
    """The DAU stream with a state store; its checkpoint is lost midway and
    the whole topic is read again."""
    from daystream.plans import jobs
    from daystream.streaming import jobs as sjobs
    out = scratch_path(spark, "r-dims")
    jobs.process_change_batch(spark, change_envelopes_from(
        spark, sf, tables=("user_info", "base_province")), out)
    src, sink = scratch_path(spark, "r-pages"), scratch_path(spark, "r-dau")
    for i, half in enumerate(_halves(_page_messages(spark, sf))):
        half.write.mode("append").parquet(src)
        sjobs.start_dau(sjobs.page_records(_stream_of(spark, src)), f"{out}/dims", sink,
                        scratch_path(spark, f"r-dau-ck{i}"), trigger={"availableNow": True},
                        as_of=AS_OF, tz=TZ, mode="state", watermark="400 days").awaitTermination()
    stored = read_table(spark, sink, schemas.DAU_INFO)
    return stored.groupBy("dt", "mid").agg(F.count(F.lit(1)).alias("rows"))


def q_stream_dau_state_rows(spark, sf):
    """The DAU stream with a state store, every arrival in shuffled order: the
    whole records, each the earliest page of its device and day."""
    from daystream.plans import jobs
    from daystream.streaming import jobs as sjobs
    out = scratch_path(spark, "t-dims")
    jobs.process_change_batch(spark, change_envelopes_from(
        spark, sf, tables=("user_info", "base_province")), out)
    src, sink, ck = (scratch_path(spark, n) for n in ("t-pages", "t-dau", "t-ck"))
    shuffled = _page_messages(spark, sf).repartition("value")

    def run():
        sjobs.start_dau(sjobs.page_records(_stream_of(spark, src)), f"{out}/dims", sink, ck,
                        trigger={"availableNow": True}, as_of=AS_OF, tz=TZ, mode="state",
                        watermark="2 days").awaitTermination()

    _arrive_in_slices(spark, shuffled, src, run, slices=2)
    return read_table(spark, sink, schemas.DAU_INFO)


def q_stream_dau_late_rows(spark, sf):
    """The DAU stream with a state store that remembers one day; the last ten
    days arrive first, then the ten days before them, then the first ones: all late."""
    from daystream.plans import jobs
    from daystream.streaming import jobs as sjobs
    out = scratch_path(spark, "o-dims")
    jobs.process_change_batch(spark, change_envelopes_from(
        spark, sf, tables=("user_info", "base_province")), out)
    src, sink, ck = (scratch_path(spark, n) for n in ("o-pages", "o-dau", "o-ck"))
    messages = stage(spark, _page_messages(spark, sf), "o-messages")
    day = dt_of(F.unix_millis("timestamp"), TZ)
    for lo, hi in (("2024-01-21", "9999"), ("2024-01-11", "2024-01-21"), ("0000", "2024-01-11")):
        messages.where((day >= lo) & (day < hi)).write.mode("append").parquet(src)
        sjobs.start_dau(sjobs.page_records(_stream_of(spark, src)), f"{out}/dims", sink, ck,
                        trigger={"availableNow": True}, as_of=AS_OF, tz=TZ, mode="state",
                        watermark="1 day").awaitTermination()
    return read_table(spark, sink, schemas.DAU_INFO)


def q_dim_point_lookup(spark, sf):
    """User rows for the users of all first-seen pages, from the index: two
    levels folded from batches, the last batch not folded."""
    from daystream.plans import jobs
    from daystream.sinks import dim_index
    out, index, run = scratch_path(spark, "p-store"), scratch_path(spark, "p-index"), jobs.new_run()
    env = stage(spark, change_envelopes_from(spark, sf, tables=("user_info", "base_province")), "dim-changes")
    slot = F.col("offset") % 16
    parts = [env.where(slot.isin(6, 8)), env.where((slot == 7) & (F.col("partition") < 2)),
             env.where((slot == 9) | ((slot == 7) & (F.col("partition") >= 2)))]
    for b, part in enumerate(parts):
        jobs.process_change_batch(spark, part, out, b, on_delete="drop", run_id=run)
        if b < 2:
            dim_index.fold(spark, f"{out}/dims", index)
    ids = _first_seen(spark, sf).select("user_id")
    found = dim_index.lookup(spark, f"{out}/dims", index, "user_info", ids)
    return found.select("table", "id", "op", "src_partition", "src_offset")


def q_dau_upsert_versions(spark, sf):
    """As dau_upsert, with versions that one small file switches."""
    from daystream.sinks.versions import read_versions, upsert_versions
    path = scratch_path(spark, "v-dau")
    whole = stage(spark, _dau(spark, sf), "dau-month")
    upsert_versions(spark, whole.where(F.col("dt") <= SPLIT_DT), path, ["dt", "mid"])
    for _ in range(2):
        upsert_versions(spark, whole, path, ["dt", "mid"])
    return read_versions(spark, path, schemas.DAU_INFO)


def q_stream_dau_ledger(spark, sf):
    """The DAU job over all page messages, garbage included: its saved positions."""
    from daystream.plans import jobs
    from daystream.streaming import jobs as sjobs
    out, src, ck = (scratch_path(spark, n) for n in ("l-dau", "l-pages", "l-ck"))

    def run():
        sjobs.start_dau_messages(_stream_of(spark, src), scratch_path(spark, "no-dims"), out, ck,
                                 trigger={"availableNow": True}, as_of=AS_OF, tz=TZ).awaitTermination()

    _arrive_in_slices(spark, _page_messages(spark, sf), src, run)
    return jobs.read_ledger(spark, f"{out}/ledger").select("group_id", "topic", "partition", "until_offset")


def q_read_from_offsets_pruned(spark, sf):
    """As read_from_offsets, from stored files whose row groups the positions skip."""
    from daystream.sinks.message_log import append_log, read_from_positions
    path = scratch_path(spark, "m-log")
    append_log(log_envelopes_from(spark, sf), path)
    saved = stage(spark, _log_ledger(spark, sf, SPLIT_DT), "ledger")
    return read_from_positions(spark, path, saved, LOG_GROUP, LOG_TOPIC).select("partition", "offset")


def q_ledger_fenced(spark, sf):
    """Five saves of one run, then a second run whose batch 0 saves the whole log;
    the first run is refused from then on, and a row that it wrote past
    the fence with a clock ahead doesn't count."""
    from daystream.plans import jobs
    from daystream.sinks.fence import StaleWriter, begin_run
    path = scratch_path(spark, "f-ledger")
    env = stage(spark, log_envelopes_from(spark, sf).select("topic", "partition", "offset"), "log-positions")
    old = begin_run(spark, path)
    for b in range(5):
        jobs.save_ledger(spark, path, env.where(F.col("offset") % 16 <= b), LOG_GROUP, b, old)
    jobs.save_ledger(spark, path, env, LOG_GROUP, 0, begin_run(spark, path))
    behind = env.where(F.col("offset") % 16 == 5)
    try:
        jobs.save_ledger(spark, path, behind, LOG_GROUP, 5, old)
        raise AssertionError("an overtaken run could save")
    except StaleWriter:
        pass
    (ledger.save_rows(ledger.offset_ranges(behind), LOG_GROUP, 5, old)
     .withColumn("saved_at", F.current_timestamp() + F.expr("interval 1 day")).write.mode("append").parquet(path))
    return jobs.read_ledger(spark, path)


def q_cdc_replay_routing(spark, sf):
    """The change split of all changes, then its replay after the lists were
    swapped: messages per topic and rows per dimension table, as in the first try."""
    from daystream.plans import jobs
    out, run, lists = scratch_path(spark, "y-cdc"), jobs.new_run(), routing_table(spark)
    swapped = lists.withColumn("kind", F.when(F.col("kind") == "fact", "dim").otherwise("fact"))
    env = stage(spark, change_envelopes_from(spark, sf), "changes")
    for routing_now in (lists, swapped):
        jobs.process_change_batch(spark, env, out, 0, routing=routing_now, run_id=run, record_routing=True)
    return _split_counts(spark, out)


def q_stream_funnel_log(spark, sf):
    """The DAU job over all page messages in stretches: the counts that its batches kept."""
    from daystream.plans import jobs
    from daystream.sinks import funnel_log
    from daystream.streaming import jobs as sjobs
    dims_out = scratch_path(spark, "u-dims")
    jobs.process_change_batch(spark, change_envelopes_from(
        spark, sf, tables=("user_info", "base_province")), dims_out, 0)
    out, src, ck = (scratch_path(spark, n) for n in ("u-dau", "u-pages", "u-ck"))

    def run():
        sjobs.start_dau_messages(_stream_of(spark, src), f"{dims_out}/dims", out, ck, fenced=True, funnel=True,
                                 trigger={"availableNow": True}, as_of=AS_OF, tz=TZ).awaitTermination()

    _arrive_in_slices(spark, _page_messages(spark, sf), src, run, slices=2)
    return funnel_log.totals(funnel_log.read_counts(spark, f"{out}/funnel"))


def q_route_payloads(spark, sf):
    """Every message of the log split parsed back: the fields of its target's
    schema, as text, by topic and position."""
    msgs = log_split.route_messages(_parsed(spark, sf))
    names = ["mid", "user_id", "province_id", "channel", "is_new", "model", "operate_system",
             "version_code", "brand", "page_id", "last_page_id", "page_item", "page_item_type",
             "during_time", "sourceType", "display_type", "display_item", "display_order",
             "display_pos_id", "action_id", "action_item", "action_ts", "entry", "open_ad_id",
             "loading_time_ms", "open_ad_ms", "open_ad_skip_ms", "ts"]
    known = msgs.where(~F.col("topic").isin(routing.ERROR_TOPIC, routing.DEAD_LETTER_TOPIC))
    j = F.from_json("value", ", ".join(f"{n} string" for n in names)).alias("j")
    return known.select("topic", "src_partition", "src_offset", j).select(
        "topic", "src_partition", "src_offset", "j.*")


def q_cdc_fact_payloads(spark, sf):
    routed = cdc.fact_route(cdc.with_op(_changes(spark, sf)), routing_table(spark), key="id")
    names = ["id", "user_id", "order_status", "total_amount", "create_time", "order_id", "sku_id",
             "sku_num", "order_price", "name", "region_id", "area_code", "iso_code", "iso_3166_2"]
    j = F.from_json("value", ", ".join(f"{n} string" for n in names)).alias("j")
    out = routed.select("topic", "key", "src_partition", "src_offset", j).select(
        "topic", "key", "src_partition", "src_offset", "j.*")
    # numbers as numbers: their text form is the writer's choice
    return out.withColumn("total_amount", F.col("total_amount").cast("double")).withColumn(
        "order_price", F.col("order_price").cast("double"))


def _split_counts(spark, out):
    from daystream.plans import jobs
    topics = spark.read.parquet(f"{out}/topics").select(F.col("topic").alias("target"))
    rows = jobs.read_dims(spark, f"{out}/dims").select(
        F.concat(F.lit("DIM:"), F.upper("table")).alias("target"))
    return topics.unionByName(rows).groupBy("target").agg(F.count(F.lit(1)).alias("rows"))


def q_stream_cdc_split(spark, sf):
    """The change split as a stream of two batches: messages per topic, and per
    dimension table the rows of the store."""
    from daystream.streaming import jobs as sjobs
    src, out, ck = (scratch_path(spark, n) for n in ("s-cdc", "s-cdc-out", "s-cdc-ck"))

    def run():
        sjobs.start_change_split(_stream_of(spark, src), out, ck,
                                 trigger={"availableNow": True}).awaitTermination()

    _arrive_in_slices(spark, _changes_with_garbage(spark, sf), src, run, slices=2, keep=False)
    return _split_counts(spark, out)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_envelope": q_parse_envelope,
    "parse_page_log": q_parse_page_log,
    "page_log": q_page_log,
    "display_log": q_display_log,
    "action_log": q_action_log,
    "start_log": q_start_log,
    "error_log": q_error_log,
    "dead_letter": q_dead_letter,
    "log_route_counts": q_log_route_counts,
    "route_all_topics": q_route_all_topics,
    "cdc_op_map": q_cdc_op_map,
    "cdc_fact_route": q_cdc_fact_route,
    "cdc_route_counts": q_cdc_route_counts,
    "dim_latest": q_dim_latest,
    "session_first_pages": q_session_first_pages,
    "dau_first_seen": q_dau_first_seen,
    "date_parts": q_date_parts,
    "user_age": q_user_age,
    "dau_user_join": q_dau_user_join,
    "dau_province_join": q_dau_province_join,
    "dau_info": q_dau_info,
    "dau_seen_mids": q_dau_seen_mids,
    "dau_new_only": q_dau_new_only,
    "dau_new_only_indexed": q_dau_new_only_indexed,
    "dau_upsert": q_dau_upsert,
    "dau_funnel_counts": q_dau_funnel_counts,
    "project_by_name": q_project_by_name,
    "offset_ranges": q_offset_ranges,
    "offset_ledger_save": q_offset_ledger_save,
    "offset_ledger_read": q_offset_ledger_read,
    "read_from_offsets": q_read_from_offsets,
    "stream_route_counts": q_stream_route_counts,
    "stream_dau_info": q_stream_dau_info,
    "page_dead_letter": q_page_dead_letter,
    "cdc_dead_letter": q_cdc_dead_letter,
    "stream_log_restart": q_stream_log_restart,
    "ledger_restart": q_ledger_restart,
    "dim_store_batches": q_dim_store_batches,
    "dim_store_fenced": q_dim_store_fenced,
    "stream_dau_state_restore": q_stream_dau_state_restore,
    "stream_dau_state_rows": q_stream_dau_state_rows,
    "stream_dau_late_rows": q_stream_dau_late_rows,
    "dim_point_lookup": q_dim_point_lookup,
    "dau_upsert_versions": q_dau_upsert_versions,
    "stream_dau_ledger": q_stream_dau_ledger,
    "route_payloads": q_route_payloads,
    "cdc_fact_payloads": q_cdc_fact_payloads,
    "stream_cdc_split": q_stream_cdc_split,
    "read_from_offsets_pruned": q_read_from_offsets_pruned,
    "ledger_fenced": q_ledger_fenced,
    "cdc_replay_routing": q_cdc_replay_routing,
    "stream_funnel_log": q_stream_funnel_log,
}
