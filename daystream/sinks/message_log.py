"""Messages as files that are read from positions without reading them all.

A folder per topic; its files hold ranges of (partition, offset) and are sorted by
them, so a file's row groups have narrow smallest and largest values. The saved
positions of a topic become one predicate over both columns that reaches the
Parquet scan, and row groups behind the positions are skipped by their statistics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daystream import schemas
from daystream.operators.ledger import ledger_read


#: Bytes of a row group: the least that is skipped or read.
ROW_GROUP = 16 << 20


def append_log(env: DataFrame, path: str, row_group: int = ROW_GROUP) -> None:
    """Add envelopes to the log: range-partitioned, so a hot partition is spread over tasks."""
    order = ["topic", "partition", "offset"]
    (env.select(*schemas.ENVELOPE.names).repartitionByRange(*order).sortWithinPartitions(*order)
     .write.mode("append").option("parquet.block.size", str(row_group)).partitionBy("topic").parquet(path))


def _joined(parts: list[Column], op) -> Column:
    """One condition of many, as a balanced tree (a topic may have thousands of partitions)."""
    while len(parts) > 1:
        parts = [op(*parts[i:i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def from_positions(positions: dict[int, int]) -> Column:
    """Messages at or after the position of their partition, and all of other partitions.

    Written with comparisons only (no IN list), which Parquet filters take at any length.
    """
    if not positions:
        return F.lit(True)
    p, o = F.col("partition"), F.col("offset")
    others = _joined([p != F.lit(k) for k in positions], lambda a, b: a & b)
    return _joined([(p == F.lit(k)) & (o >= F.lit(v)) for k, v in positions.items()] + [others], lambda a, b: a | b)


def read_from_positions(spark: SparkSession, path: str, ledger: DataFrame, group_id: str, topic: str) -> DataFrame:
    """What :func:`daystream.operators.ledger.read_from_offsets` gives, from a
    stored log. On the driver: the saved positions of one topic."""
    saved = {r["partition"]: r["until_offset"] or 0 for r in ledger_read(ledger, group_id, topic).collect()}
    log = spark.read.schema(schemas.ENVELOPE).parquet(path).where(F.col("topic") == topic)
    return log.where(from_positions(saved)).select(*schemas.ENVELOPE.names)
