"""daystream: a Spark-native real-time warehouse.

Splits raw app logs into typed page / display / action / start / error
streams, splits database change events into per-table fact streams and
latest-value dimensions, and computes daily active users (first page per
device and day, enriched with user and province dimensions, upserted
idempotently by day and device).

Every transform is a ``DataFrame -> DataFrame`` function shared by batch
and Structured Streaming; only ``daystream.streaming`` deals with
triggers and checkpoints.
"""

from daystream.session import checkpoint_root, get_spark

__all__ = ["checkpoint_root", "get_spark"]
