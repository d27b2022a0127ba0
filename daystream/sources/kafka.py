"""Kafka sources (batch and streaming) in the envelope layout.

The Kafka connector is not bundled with PySpark; these functions only build
the standard reader options and fail at ``load()`` when the connector is
missing. Resume positions come from the offset ledger: the ledger holds
one row per partition of a topic, so turning it into the
``startingOffsets`` option reads a bounded number of rows.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daystream.operators.ledger import ledger_read


def offsets_option(ledger: DataFrame, group_id: str, topic: str) -> str | None:
    """``startingOffsets`` JSON (``{"topic": {"0": 42, ...}}``) from the saved
    positions of ``(group_id, topic)``; ``None`` when nothing is saved (the
    caller then starts at the group's default position)."""
    rows = ledger_read(ledger, group_id, topic).collect()  # one row per partition of the topic
    if not rows:
        return None
    return json.dumps({topic: {str(r.partition): int(r.until_offset) for r in rows}})


def start_position(ledger: DataFrame | None, group_id: str, topic: str,
                   default: str = "latest") -> str:
    """Where a new query of ``group_id`` starts reading ``topic``: at the saved
    positions if there are any, else at ``default``. For ``starting`` of
    :func:`kafka_batch` and :func:`kafka_stream`."""
    saved = offsets_option(ledger, group_id, topic) if ledger is not None else None
    return saved if saved is not None else default


def _envelope(df: DataFrame) -> DataFrame:
    return df.select(F.col("key").cast("string").alias("key"),
                     F.col("value").cast("string").alias("value"),
                     "topic", "partition", "offset", "timestamp")


def _reader(r, bootstrap: str, topic: str, starting: str, extra: dict | None,
            min_partitions: int | None):
    r = (r.format("kafka").option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", topic).option("startingOffsets", starting))
    if min_partitions:
        r = r.option("minPartitions", str(min_partitions))
    for k, v in (extra or {}).items():
        r = r.option(k, v)
    return r


def kafka_batch(spark: SparkSession, bootstrap: str, topic: str,
                starting: str = "earliest", ending: str = "latest",
                extra: dict | None = None, min_partitions: int | None = None) -> DataFrame:
    """A bounded read of ``topic`` between two positions (batch back-fill)."""
    r = _reader(spark.read, bootstrap, topic, starting, extra, min_partitions)
    return _envelope(r.option("endingOffsets", ending).load())


def kafka_stream(spark: SparkSession, bootstrap: str, topic: str,
                 starting: str = "latest", extra: dict | None = None,
                 max_offsets_per_trigger: int | None = None,
                 min_partitions: int | None = None) -> DataFrame:
    """Streaming read of ``topic``. ``starting`` (``latest``, ``earliest`` or
    the JSON of :func:`offsets_option`) applies on the first start only;
    afterwards the query checkpoint decides."""
    r = _reader(spark.readStream, bootstrap, topic, starting, extra, min_partitions)
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return _envelope(r.load())
