"""Offset ledger: offset ranges of a batch, save / read of resume positions,
and reading a topic from saved positions.

Structured Streaming keeps its own offsets in the checkpoint; the ledger is
the user-visible record ``(group_id, topic, partition, until_offset,
batch_id, saved_at, run)`` of how far each consumer group got, kept as a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def offset_ranges(env: DataFrame, batch_col: str | None = None) -> DataFrame:
    """Per ``(topic, partition)`` (and batch, if given): ``from_offset`` =
    first offset read, ``until_offset`` = last offset + 1 (exclusive)."""
    keys = ([batch_col] if batch_col else []) + ["topic", "partition"]
    return env.groupBy(*keys).agg(
        F.min("offset").alias("from_offset"),
        (F.max("offset") + 1).alias("until_offset"))


def ledger_save(ledger: DataFrame | None, ranges: DataFrame, group_id: str,
                batch_id) -> DataFrame:
    """Records the end offsets of a processed batch for ``group_id``.

    A save replaces the stored position of each listed partition (it is
    not a maximum: a rewound consumer moves back) and leaves unlisted
    partitions alone. ``batch_id`` is a literal or the name of a column of
    ``ranges``; of several saves of one partition the latest in time wins
    (of one moment, the later batch): batch numbers alone start again at 0
    with every new checkpoint.
    """
    new = save_rows(ranges, group_id, batch_id)
    rows = new if ledger is None else ledger.unionByName(new, allowMissingColumns=True)
    return latest(rows)


def save_rows(ranges: DataFrame, group_id: str, batch_id, run: int | None = None) -> DataFrame:
    """The rows one save appends to the ledger log; ``run`` is the number of a
    fenced run (:mod:`daystream.sinks.fence`), NULL for one without."""
    b = F.col(batch_id) if isinstance(batch_id, str) else F.lit(batch_id)
    return ranges.select(F.lit(group_id).alias("group_id"), "topic",
                         F.col("partition").cast("int").alias("partition"),
                         F.col("until_offset").cast("bigint").alias("until_offset"),
                         b.cast("bigint").alias("batch_id"),
                         F.current_timestamp().alias("saved_at"),
                         F.lit(run).cast("bigint").alias("run"))


def latest(saves: DataFrame) -> DataFrame:
    """Current ledger from a log of saves ``(group_id, topic, partition,
    until_offset, batch_id, saved_at, run)``: per partition, the position of its
    latest save (a replayed batch repeats its rows, which changes nothing).

    Saves of fenced runs are ordered by run and batch, whatever the clocks of
    their drivers say, and come after those without a run, which are ordered by time.
    """
    for name, kind in (("saved_at", "timestamp"), ("run", "bigint")):
        if name not in saves.columns:
            saves = saves.withColumn(name, F.lit(None).cast(kind))
    row = F.struct("until_offset", "batch_id", "saved_at", "run")
    order = F.struct("run", F.when(F.col("run").isNull(), F.col("saved_at")), "batch_id")
    return (saves.groupBy("group_id", "topic", "partition")
            .agg(F.max_by(row, order).alias("r"))
            .select("group_id", "topic", "partition", "r.*"))


def ledger_read(ledger: DataFrame, group_id: str, topic: str) -> DataFrame:
    """Saved positions of ``(group_id, topic)``: ``(partition, until_offset)``."""
    return (ledger.where((F.col("group_id") == group_id) & (F.col("topic") == topic))
            .select("partition", "until_offset"))


def read_from_offsets(env: DataFrame, ledger: DataFrame, group_id: str,
                      topic: str) -> DataFrame:
    """Messages of ``topic`` at or after the saved position of each partition;
    partitions without a saved position are read from the beginning."""
    start = ledger_read(ledger, group_id, topic)
    m = env.where(F.col("topic") == topic).join(start, "partition", "left")
    return (m.where(F.col("offset") >= F.coalesce(F.col("until_offset"), F.lit(0)))
            .drop("until_offset"))
