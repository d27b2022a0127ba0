"""Batch forms of the three jobs (the streaming forms reuse the same
per-batch functions, see ``daystream.streaming``).

* log split: envelopes -> all routed messages (one pass) + ledger save
* change split: envelopes -> fact messages + latest dimension rows + dead
  letters + ledger
* daily active users: page messages -> first seen per (dt, mid), minus the
  devices already in the result table -> dimensions -> append + dead letters
  + ledger

Each takes envelopes from anywhere (:func:`daystream.sources.kafka.kafka_batch`,
files in the envelope layout); the ``*_job`` forms make them from a folder of
the provided tables. ``run_id`` names the run that numbers the batches: the
same run and batch replaces what it wrote before. The ``*_job`` forms are a new
run unless they are given one.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daystream import schemas
from daystream.functions.routing import DEAD_LETTER_TOPIC, PAGE_TOPIC
from daystream.operators import cdc, dau, ledger, log_split
from daystream.operators.parse import dead_letter, parse_log, read_page_messages
from daystream.sinks.dims import append_dims, read_dims
from daystream.sinks.fence import check_run
from daystream.sinks.funnel_log import append_counts
from daystream.sinks.routing_log import recorded_routing
from daystream.sinks.seen_index import seen_keys
from daystream.sinks.topics import write_messages
from daystream.sinks.upsert import (append_partitions, read_table, staged, table_exists,
                                    touched_partitions)
from daystream.sources.envelopes import (CHANGE_TOPIC, LOG_TOPIC, change_envelopes_from,
                                         log_envelopes_from, routing_table)

# Consumer groups of the log split and the change split.
LOG_GROUP = "g1"
CHANGE_GROUP = "ODS_BASE_DB_GROUP"
#: Consumer group of the DAU job.
DAU_GROUP = "dwd_dau"


def new_run() -> str:
    return uuid.uuid4().hex[:12]


@contextmanager
def _kept(df: DataFrame, persist: bool):
    """``df``, held in memory and on disk for the block if ``persist``: right for
    a bounded micro-batch that several outputs read, not for a back-fill, whose
    file source is better read again."""
    if not persist:
        yield df
        return
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def save_ledger(spark: SparkSession, path: str, env: DataFrame, group_id: str,
                batch_id: int, run: int | None = None) -> None:
    """Ledger save after a batch is processed: the end offsets of every
    partition the batch read (only the position columns of ``env`` are
    read: ``topic, partition, offset``) are appended to the ledger log at
    ``path``; :func:`read_ledger` gives the current positions. Appending
    one tiny file per batch keeps the per-batch cost flat; the rows of all
    tasks meet in the aggregate's shuffle, one row per partition after it.

    ``run``: number of a fenced run (:func:`daystream.sinks.fence.begin_run`); its
    saves are refused once a later run has begun, and none depends on a clock."""
    if run is not None:
        check_run(spark, path, run)
    ranges = ledger.offset_ranges(env.select("topic", "partition", "offset"))
    (ledger.save_rows(ranges, group_id, batch_id, run).repartition(1)
     .write.mode("append").parquet(path))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Current positions ``(group_id, topic, partition, until_offset,
    batch_id)`` from the ledger log, empty if there is none yet."""
    return _current_saves(spark, path).drop("saved_at", "run")


def _current_saves(spark: SparkSession, path: str) -> DataFrame:
    if not table_exists(spark, path):
        return spark.createDataFrame([], schemas.LEDGER)
    return ledger.latest(spark.read.schema(schemas.LEDGER).parquet(path))


def compact_ledger(spark: SparkSession, path: str) -> None:
    """Replace the ledger log by its current positions (one row per
    partition), staged first. For a time without a running job: rows saved
    while it runs would be lost."""
    with staged(spark, _current_saves(spark, path), "ledger-compact") as current:
        current.repartition(1).write.mode("overwrite").parquet(path)


def process_log_batch(spark: SparkSession, env: DataFrame, out_dir: str, batch_id: int = 0,
                      group_id: str = LOG_GROUP, persist: bool = False,
                      sink_format: str = "parquet", sink_options: dict | None = None,
                      run_id: str = "batch", fence: int | None = None) -> None:
    """One batch of the log split: every routed message in one pass (to
    ``out_dir/topics``, or to Kafka with ``sink_format="kafka"``), then the
    ledger. ``persist``: see :func:`_kept`. ``fence``: number of a fenced run, see
    :func:`save_ledger`; an overtaken run stops before its first output."""
    if fence is not None:
        check_run(spark, os.path.join(out_dir, "ledger"), fence)
    with _kept(env, persist) as env:
        msgs = log_split.route_messages(parse_log(env))
        write_messages(msgs, os.path.join(out_dir, "topics"), batch_id=batch_id,
                       fmt=sink_format, options=sink_options, run_id=run_id)
        save_ledger(spark, os.path.join(out_dir, "ledger"), env, group_id, batch_id, fence)


def log_split_job(spark: SparkSession, sf_dir: str, out_dir: str, batch_id: int = 0,
                  run_id: str | None = None) -> str:
    process_log_batch(spark, log_envelopes_from(spark, sf_dir), out_dir, batch_id,
                      run_id=run_id or new_run())
    return out_dir


def process_change_batch(spark: SparkSession, env: DataFrame, out_dir: str, batch_id: int = 0,
                         routing: DataFrame | None = None, on_delete: str = "keep",
                         group_id: str = CHANGE_GROUP, sink_format: str = "parquet",
                         sink_options: dict | None = None, run_id: str = "batch",
                         persist: bool = False, key: str | None = None,
                         fence: int | None = None, record_routing: bool = False) -> None:
    """One batch of the change split: fact messages and dead letters
    (``out_dir/topics``), the latest row per changed dimension key (appended to
    the store at ``out_dir/dims``), the ledger.

    ``routing`` is the current ``(table, kind)`` list, by default the built-in
    one. ``key``: field of the row image that becomes the message key.
    ``persist`` keeps the parsed batch in memory for the several outputs, right for a small one.
    ``record_routing`` keeps the lists the batch is routed with
    (``out_dir/routing``), and a replay of the same run and batch uses them again
    instead of ``routing``. ``fence``: see :func:`process_log_batch`; it orders the
    dimension rows too.

    Each source is read and parsed once: messages, dimension rows and positions come from the
    parse, which is staged under the checkpoint root for the length of the batch: a
    copy in memory costs more to make, and the first batch of a topic may be all of it.
    """
    if fence is not None:
        check_run(spark, os.path.join(out_dir, "ledger"), fence)
    routing = routing if routing is not None else routing_table(spark)
    if record_routing:
        routing = recorded_routing(spark, os.path.join(out_dir, "routing"), run_id, batch_id, routing)
    parsed = cdc.parse_changes(env)
    with _kept(parsed, True) if persist else staged(spark, parsed, "changes") as parsed:
        msgs = cdc.route_messages(parsed, routing, key=key)
        write_messages(msgs, os.path.join(out_dir, "topics"),
                       batch_id=batch_id, fmt=sink_format, options=sink_options, run_id=run_id)
        latest = cdc.dim_latest(cdc.dim_changes(cdc.with_op(parsed), routing))
        append_dims(latest, os.path.join(out_dir, "dims"), run_id, batch_id, on_delete, fence)
        # positions of every message read, including dropped change types
        positions = parsed.select(F.col("src_topic").alias("topic"),
                                  F.col("src_partition").alias("partition"),
                                  F.col("src_offset").alias("offset"))
        save_ledger(spark, os.path.join(out_dir, "ledger"), positions, group_id, batch_id, fence)


def cdc_split_job(spark: SparkSession, sf_dir: str, out_dir: str, batch_id: int = 0,
                  run_id: str | None = None) -> str:
    process_change_batch(spark, change_envelopes_from(spark, sf_dir), out_dir, batch_id,
                         run_id=run_id or new_run())
    return out_dir


def seen_devices(spark: SparkSession, dau_path: str, days: list[str] | None = None) -> DataFrame:
    """Devices already counted, ``(dt, mid)``, for ``days`` (default: all;
    read with a partition filter and only the ``mid`` column). A result
    table that does not exist yet reads as empty."""
    if not table_exists(spark, dau_path):
        return spark.createDataFrame([], "dt string, mid string")
    stored = read_table(spark, dau_path, schemas.DAU_INFO)
    if days is not None:
        stored = stored.where(F.col("dt").isin(days))
    return dau.seen_mids(stored)


def _stored_keys(spark: SparkSession, dau_path: str, batch: DataFrame, seen_index: str | None) -> DataFrame:
    """Stored ``(dt, mid)`` to check a batch against: those of its days, or by
    the index those of its devices."""
    if seen_index is not None:
        return seen_keys(spark, dau_path, seen_index, batch)
    stored = read_table(spark, dau_path, schemas.DAU_INFO).select("dt", "mid")
    return touched_partitions(stored, batch, "dt")


def process_page_batch(spark: SparkSession, pages: DataFrame, dims: DataFrame | Callable, dau_path: str,
                       as_of=None, tz: str | None = None,
                       record: Callable[[DataFrame], None] | None = None,
                       seen_index: str | None = None) -> None:
    """One batch of typed page records of the DAU job. ``dims``: the current
    dimension rows, or a function that finds those of the batch's pages
    (:func:`daystream.sinks.dim_index.dims_of`).

    The result table is the seen-set: devices already stored for a day are
    removed (:func:`daystream.operators.dau.new_only` against only the days
    present in the batch), the rest are enriched and appended: their keys are
    new, so no stored partition is rewritten. Replaying a batch therefore
    adds nothing twice, and losing the streaming state loses nothing.

    The first-seen rows are staged under the checkpoint root for the length of
    the batch: the same rows feed the touched-day probe, both joins and the
    write, and the lineage back to the source is cut. ``record`` gets the batch's
    funnel (:func:`daystream.operators.dau.batch_funnel`) before the rows are appended.
    With ``seen_index`` (:mod:`daystream.sinks.seen_index`) the stored days are asked
    for the batch's devices instead of being read.
    """
    usable = pages.where(F.col("mid").isNotNull() & F.col("ts").isNotNull())
    first = dau.first_seen(dau.session_first_pages(usable), tz=tz)
    with staged(spark, first, "dau-first-seen") as first:
        if table_exists(spark, dau_path):
            first = dau.new_only(first, _stored_keys(spark, dau_path, first, seen_index))
        dims = dims(first) if callable(dims) else dims
        users, provinces = cdc.user_dim(dims), cdc.province_dim(dims)
        if record is not None:
            record(dau.batch_funnel(pages, first, users, provinces))
        out = dau.dau_info(first, users, provinces, as_of=as_of, tz=tz)
        append_partitions(out.repartitionByRange("dt", "mid"), dau_path)


def process_first_pages(spark: SparkSession, first: DataFrame, dims: DataFrame | Callable, dau_path: str,
                        as_of=None, tz: str | None = None, check_all: bool = False,
                        seen_index: str | None = None) -> None:
    """One batch of first-seen pages that a state store chose (with ``dt`` and
    ``late``): the late ones are checked against their stored days, the others
    are appended without reading the table. ``check_all`` checks them all, for
    a batch that may have been appended before (a replay)."""
    with staged(spark, first, "dau-first-seen") as first:
        doubt = first if check_all else first.where("late")
        if table_exists(spark, dau_path) and not doubt.isEmpty():
            new = dau.new_only(doubt, _stored_keys(spark, dau_path, doubt, seen_index))
            first = new if check_all else first.where("not late").unionByName(new)
        dims = dims(first) if callable(dims) else dims
        out = dau.dau_info(first.drop("late"), cdc.user_dim(dims), cdc.province_dim(dims), as_of=as_of, tz=tz)
        append_partitions(out.repartitionByRange("dt", "mid"), dau_path)


def process_page_messages(spark: SparkSession, env: DataFrame, dims: DataFrame, out_dir: str,
                          batch_id: int = 0, as_of=None, tz: str | None = None,
                          group_id: str = DAU_GROUP, persist: bool = False,
                          run_id: str = "batch", fence: int | None = None,
                          funnel: bool = False, seen_index: str | None = None) -> None:
    """One batch of page-topic messages: the DAU rows (``out_dir/dau``), the
    messages that are no page record (``out_dir/topics``, dead letters), then
    the end positions of all messages read (``out_dir/ledger``). ``funnel`` keeps
    the batch's counts by stage and task (``out_dir/funnel``). ``fence``: see
    :func:`process_log_batch`; ``seen_index``: see :func:`process_page_batch`."""
    if fence is not None:
        check_run(spark, os.path.join(out_dir, "ledger"), fence)

    def record(counts: DataFrame) -> None:
        append_counts(spark, counts, os.path.join(out_dir, "funnel"), run_id, batch_id)

    with _kept(env, persist) as env:
        read = read_page_messages(env)
        dead = dead_letter(read).select(
            F.lit(DEAD_LETTER_TOPIC).alias("topic"), F.lit(None).cast("string").alias("key"),
            F.coalesce("value", F.lit("")).alias("value"))
        write_messages(dead, os.path.join(out_dir, "topics"), batch_id=batch_id,
                       run_id=run_id)
        process_page_batch(spark, read.where(F.col("dead_reason").isNull()), dims,
                           os.path.join(out_dir, "dau"), as_of=as_of, tz=tz,
                           record=record if funnel else None, seen_index=seen_index)
        save_ledger(spark, os.path.join(out_dir, "ledger"), env, group_id, batch_id, fence)


def page_messages(pages: DataFrame) -> DataFrame:
    """Typed page records with their position as page-topic envelopes."""
    return pages.select(
        F.lit(None).cast("string").alias("key"),
        F.to_json(F.struct(*schemas.PAGE_LOG.names)).alias("value"),
        F.lit(PAGE_TOPIC).alias("topic"),
        F.col("src_partition").alias("partition"), F.col("src_offset").alias("offset"),
        F.timestamp_millis("ts").alias("timestamp"))


def dau_job(spark: SparkSession, sf_dir: str, dau_path: str, dims_path: str | None = None,
            as_of=None, tz: str | None = None) -> str:
    pages = log_split.page_log(parse_log(log_envelopes_from(spark, sf_dir)), with_position=True)
    if dims_path and table_exists(spark, dims_path):
        dims = read_dims(spark, dims_path)
    else:
        changes = cdc.with_op(cdc.parse_changes(
            change_envelopes_from(spark, sf_dir, tables=("user_info", "base_province"))))
        dims = cdc.dim_latest(cdc.dim_changes(changes, routing_table(spark)))
    process_page_batch(spark, pages, dims, dau_path, as_of=as_of, tz=tz)
    return dau_path


__all__ = ["CHANGE_TOPIC", "LOG_TOPIC", "cdc_split_job", "compact_ledger", "dau_job",
           "log_split_job", "new_run", "page_messages", "process_change_batch",
           "process_first_pages", "process_log_batch", "process_page_batch", "process_page_messages", "read_dims",
           "read_ledger", "save_ledger", "seen_devices"]
