"""Message sinks: one row per message ``(topic, key, value)``.

With the Kafka connector on the classpath the rows go to the bus (the
``topic`` column picks the target per row). Without it they are written as
files in a folder of their own per run and batch, ``run=<id>/batch_id=<n>``,
partitioned by topic. A replayed batch overwrites its whole folder, topics
that it no longer writes included; another run never touches it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_messages(messages: DataFrame, path: str | None = None, batch_id: int | None = None,
                   fmt: str = "parquet", options: dict | None = None,
                   run_id: str = "batch") -> None:
    """Write messages to a bus (``fmt="kafka"``) or to files at ``path``.

    ``run_id`` names the query or job run that numbers the batches: batch
    numbers start again with every new checkpoint, so they only identify a
    batch together with it.
    """
    if fmt == "kafka":
        (messages.select("topic", "key", "value").write.format("kafka")
         .options(**(options or {})).save())
        return
    folder = f"{path}/run={run_id}/batch_id={batch_id if batch_id is not None else 0}"
    (messages.select("topic", "key", "value").write.mode("overwrite")
     .option("partitionOverwriteMode", "static")
     .partitionBy("topic").format(fmt).save(folder))


def kafka_options(bootstrap: str, idempotent: bool = True) -> dict:
    """Producer settings for the Kafka sink: all in-sync replicas
    acknowledge, idempotent producer."""
    opts = {"kafka.bootstrap.servers": bootstrap, "kafka.acks": "all"}
    if idempotent:
        opts["kafka.enable.idempotence"] = "true"
    return opts
