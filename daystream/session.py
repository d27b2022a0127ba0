"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def scale_settings(input_bytes: int, cores: int, max_partitions: int = 200_000) -> dict[str, str]:
    """Partition sizing for a run over ``input_bytes`` on ``cores`` task slots.

    Shuffles start with about one partition per 256 MB of input (at least
    two per core, at most ``max_partitions``, what one driver can track) and AQE coalesces them towards 128 MB at
    run time, so no reducer holds more than a few hundred MB even when the
    input is 100 TB (~400,000 partitions capped to 200,000, i.e. ~500 MB
    each before coalescing, spill-safe with the sort-based aggregates used
    here). Scans split files at 256 MB. Skewed shuffle partitions (five
    times the median and over 512 MB) are split by AQE.
    """
    per_partition = 256 << 20
    shuffle = max(2 * cores, min(max_partitions, -(-input_bytes // per_partition)))
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(per_partition),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    }


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "daystream", checkpoint_dir: str | None = None,
              input_bytes: int | None = None, cores: int | None = None) -> SparkSession:
    """Session with the settings every job here relies on.

    On a cluster, ``master`` stays ``None`` so the launcher decides; the
    shuffle partition count then comes from the cluster config, or from
    :func:`scale_settings` when ``input_bytes`` and ``cores`` are given, and
    AQE coalesces it at run time.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
         # streaming dedup state (devices per day) lives off-heap in RocksDB,
         # so millions of keys per executor do not pressure the JVM heap
         .config("spark.sql.streaming.stateStore.providerClass",
                 "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"))
    if input_bytes and cores:
        for k, v in scale_settings(input_bytes, cores).items():
            b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if checkpoint_dir:
        # Only a default: a cluster-provided shared folder takes precedence.
        existing = SparkSession.getActiveSession()
        if existing is None or not _conf_checkpoint_dir(existing):
            b = b.config("spark.checkpoint.dir", checkpoint_dir)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator and points at shared storage;
    it is only filled in here (with a fresh local folder) when unset and
    the session runs in local mode, as in tests. A cluster session without
    it is an error: a machine-local folder is not visible to the other
    executors and does not survive losing the machine.
    """
    global _LOCAL_ROOT
    root = _conf_checkpoint_dir(spark)
    if not root:
        sc_dir = spark.sparkContext.getCheckpointDir()
        if sc_dir:
            root = sc_dir
        else:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on "
                                   "HDFS or object storage) for staging and checkpoints")
            if _LOCAL_ROOT is None:
                _LOCAL_ROOT = tempfile.mkdtemp(prefix="daystream-ckpt-")
            root = _LOCAL_ROOT
            spark.sparkContext.setCheckpointDir(root)
    return root


_LOCAL_ROOT: str | None = None


def _conf_checkpoint_dir(spark: SparkSession) -> str | None:
    return spark.sparkContext.getConf().get("spark.checkpoint.dir", None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def read_table(spark: SparkSession, sf_dir: str, name: str):
    """One provided parquet table."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
