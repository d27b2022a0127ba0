"""Structured Streaming forms of the three jobs.

Each job is ``readStream -> foreachBatch(per-batch function of
daystream.plans.jobs)`` with a checkpoint location, so offsets are
committed only after a batch's outputs are written (at-least-once), and
every sink is idempotent per batch (message files and dimension rows are keyed
by query and batch, the DAU table by ``(dt, mid)``), which makes the result
effectively once. A query keeps its id as long as its checkpoint; with a new
checkpoint it is another run and adds to what the earlier one wrote.

Sources: a file source over envelope files (the layout of Spark's Kafka
source) works everywhere; :func:`kafka_stream` builds the Kafka source
when the connector is on the classpath.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import StreamingQueryException
from pyspark.sql.streaming import StreamingQuery

from daystream import schemas
from daystream.operators import dau
from daystream.operators.parse import parse_page_messages
from daystream.plans import jobs
from daystream.sinks.dim_index import dims_of
from daystream.sinks.fence import begin_run
from daystream.sinks.upsert import table_exists
from daystream.sources.kafka import kafka_stream  # noqa: F401  (re-export)
from daystream.streaming.first_seen import first_seen_stream, keyed_state

#: Micro-batch interval of the original jobs.
DEFAULT_TRIGGER = {"processingTime": "5 seconds"}


def envelope_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming envelopes from files with the envelope schema."""
    r = spark.readStream.schema(schemas.ENVELOPE).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a query keeps in its checkpoint (written before its first batch)."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def _start(df: DataFrame, fn: Callable, checkpoint: str, trigger: dict | None,
           name: str | None) -> StreamingQuery:
    """``fn(batch, batch_id, run_id)`` for every micro-batch."""
    run_id: list[str] = []

    def each(batch: DataFrame, batch_id: int) -> None:
        if not run_id:
            run_id.append(query_id(batch.sparkSession, checkpoint))
        fn(batch, batch_id, run_id[0])

    w = df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or DEFAULT_TRIGGER))
    if name:
        w = w.queryName(name)
    return w.start()


def _fence(df: DataFrame, out_dir: str, fenced: bool) -> int | None:
    return begin_run(df.sparkSession, f"{out_dir}/ledger") if fenced else None


def start_log_split(envelopes: DataFrame, out_dir: str, checkpoint: str,
                    trigger: dict | None = None, name: str | None = None,
                    sink_format: str = "parquet",
                    sink_options: dict | None = None, fenced: bool = False) -> StreamingQuery:
    """Log split: every routed message of a batch in one pass (files under
    ``out_dir/topics`` or Kafka), then the ledger of the batch. The
    micro-batch is persisted while both steps read it. ``fenced`` (here and in the
    other jobs with a ledger) takes a run number at the start: a query that was
    started before on the same folder fails at its next batch, and positions are
    ordered by run and batch instead of by the drivers' clocks."""
    fence = _fence(envelopes, out_dir, fenced)

    def run(batch: DataFrame, batch_id: int, run_id: str) -> None:
        jobs.process_log_batch(batch.sparkSession, batch, out_dir, batch_id, persist=True,
                               sink_format=sink_format, sink_options=sink_options,
                               run_id=run_id, fence=fence)
    return _start(envelopes, run, checkpoint, trigger, name)


def start_change_split(envelopes: DataFrame, out_dir: str, checkpoint: str,
                       routing_loader: Callable[[SparkSession], DataFrame] | None = None,
                       trigger: dict | None = None, on_delete: str = "keep",
                       name: str | None = None, sink_format: str = "parquet",
                       sink_options: dict | None = None,
                       key: str | None = None, fenced: bool = False) -> StreamingQuery:
    """Change split; ``routing_loader`` is called for every batch, so the
    fact / dimension lists can change while the query runs
    (:func:`daystream.sources.envelopes.stored_routing` reads them from a
    table; without a loader they are the built-in ones). Loaded lists are recorded
    with the batch (``out_dir/routing``), and a replay uses those of its first try."""
    fence = _fence(envelopes, out_dir, fenced)

    def run(batch: DataFrame, batch_id: int, run_id: str) -> None:
        spark = batch.sparkSession
        routing = routing_loader(spark) if routing_loader else None
        jobs.process_change_batch(spark, batch, out_dir, batch_id, routing=routing,
                                  on_delete=on_delete, sink_format=sink_format,
                                  sink_options=sink_options, run_id=run_id, key=key, fence=fence, record_routing=routing_loader is not None)
    return _start(envelopes, run, checkpoint, trigger, name)


#: The page column that asks for rows of a dimension table.
_DIM_KEYS = {"user_info": "user_id", "base_province": "province_id"}


def page_records(page_messages: DataFrame) -> DataFrame:
    """Page-topic envelopes -> typed page records with their position."""
    return parse_page_messages(page_messages)


def start_dau(pages: DataFrame, dims_path: str, dau_path: str, checkpoint: str,
              trigger: dict | None = None, as_of=None, tz: str | None = None,
              mode: str = "sink", watermark: str = "2 days",
              name: str | None = None, dims_index: str | None = None,
              seen_index: str | None = None) -> StreamingQuery:
    """Daily active users from a stream of typed page records.

    ``mode="sink"``: the stored result is the seen-set. Each batch keeps the
    first page per (dt, mid) (deterministic), drops devices already stored
    for that day, enriches and appends. No streaming state; late rows of
    any age are accepted; restart and replay are idempotent.

    ``mode="state"``: a keyed state machine
    (:func:`daystream.streaming.first_seen.first_seen_stream`) holds one value per
    ``(dt, mid)`` and keeps the earliest page of a micro-batch, as sink mode does;
    state of days ``watermark`` behind the newest one ends by timer. A new
    checkpoint starts with the stored keys of those days as its state, and its
    batches are appended without reading the table. Late rows, of days whose
    state has ended, are checked against their own stored days like in sink
    mode, so rows of any age are counted. The first batch after a restart is checked
    whole, as it may be a replay of one that was appended already.

    Dimensions are re-read from ``dims_path`` in every batch, so changes
    apply to later pages (processing-time lookup); a store that does not exist
    yet is empty. With ``dims_index`` (:mod:`daystream.sinks.dim_index`) a batch
    reads the buckets of its own ids instead of the whole store, and with ``seen_index``
    (:mod:`daystream.sinks.seen_index`) those of its own devices instead of the stored days. Funnel counts per batch are published as observed metrics
    named ``dau_funnel``. Positions are not saved here: what this query gets are
    records that are parsed and, in state mode, deduplicated already;
    :func:`start_dau_messages` reads whole messages and keeps the ledger.
    """
    observed = pages.observe(
        "dau_funnel", F.count(F.lit(1)).alias("pages"),
        F.count_if(F.col("last_page_id").isNull()).alias("session_first"))
    first = dau.session_first_pages(observed)
    if mode == "state":
        first = first_seen_stream(first, watermark, tz, dau_path)
    elif mode != "sink":
        raise ValueError("mode must be 'sink' or 'state'")
    started: list[int] = []

    def run(batch: DataFrame, batch_id: int, run_id: str) -> None:
        spark = batch.sparkSession
        dims = dims_of(spark, dims_path, dims_index, _DIM_KEYS) if dims_index else jobs.read_dims(spark, dims_path)
        if mode == "sink":
            jobs.process_page_batch(spark, batch, dims, dau_path, as_of=as_of, tz=tz, seen_index=seen_index)
        else:
            jobs.process_first_pages(spark, batch, dims, dau_path, as_of=as_of, tz=tz,
                                     check_all=batch_id > 0 and not started, seen_index=seen_index)
            started.append(batch_id)

    with keyed_state(pages.sparkSession) if mode == "state" else nullcontext():
        return _start(first, run, checkpoint, trigger, name)


def start_dau_messages(messages: DataFrame, dims_path: str, out_dir: str, checkpoint: str,
                       trigger: dict | None = None, as_of=None, tz: str | None = None,
                       group_id: str = jobs.DAU_GROUP,
                       name: str | None = None, fenced: bool = False,
                       funnel: bool = False) -> StreamingQuery:
    """The whole DAU job from page-topic messages: the result (``out_dir/dau``, as
    ``mode="sink"`` of :func:`start_dau`), dead letters (``out_dir/topics``), and
    after each batch the ledger (``out_dir/ledger``), from which
    :func:`daystream.sources.kafka.start_position` finds where to go on after a
    lost checkpoint. ``funnel`` keeps each batch's counts by stage and task
    (``out_dir/funnel``, :mod:`daystream.sinks.funnel_log`)."""
    fence = _fence(messages, out_dir, fenced)

    def run(batch: DataFrame, batch_id: int, run_id: str) -> None:
        spark = batch.sparkSession
        jobs.process_page_messages(spark, batch, jobs.read_dims(spark, dims_path), out_dir,
                                   batch_id, as_of=as_of, tz=tz, group_id=group_id,
                                   persist=True, run_id=run_id, fence=fence, funnel=funnel)
    return _start(messages, run, checkpoint, trigger, name)


def supervise(spark: SparkSession, starters: dict[str, Callable[[], StreamingQuery]],
              stop_path: str, max_restarts: int = 3, poll_s: float = 5.0) -> dict[str, int]:
    """Run several queries until the marker file ``stop_path`` exists.

    ``starters`` start the queries by name. A query that fails is started again
    (from its checkpoint), at most ``max_restarts`` times each; after that the
    others are stopped and its error is raised. A query that ends by itself (``availableNow``) is done.
    The marker stops all of them, and the call returns how often each was restarted.
    """
    running = {n: start() for n, start in starters.items()}
    restarts = dict.fromkeys(starters, 0)
    try:
        while running and not table_exists(spark, stop_path):
            spark.streams.resetTerminated()  # else a query that ended long ago ends every wait
            try:
                spark.streams.awaitAnyTermination(poll_s)
            except StreamingQueryException:
                pass  # told apart below
            for n, q in list(running.items()):
                if q.isActive:
                    continue
                error = q.exception()
                if error is None:
                    del running[n]
                elif restarts[n] == max_restarts:
                    raise error
                else:
                    restarts[n] += 1
                    running[n] = starters[n]()
    finally:
        for q in running.values():
            q.stop()
        spark.streams.resetTerminated()
    return restarts


__all__ = ["envelope_stream", "kafka_stream", "page_records", "query_id", "start_change_split",
           "start_dau", "start_dau_messages", "start_log_split", "supervise"]
