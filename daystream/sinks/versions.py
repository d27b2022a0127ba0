"""Replacing partitions of a table that others read.

``data/version=<id>/<partition>=<value>/`` folders never change once written;
the manifest names the version of every partition. A replacing write adds a
version of the partitions it touches and switches them together, last.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from daystream.sinks.manifest import commit, drop_manifests, read_manifest
from daystream.sinks.upsert import drop_folder, list_folders, staged, write_clustered


def _read(spark: SparkSession, path: str, schema: StructType, col: str, parts: dict[str, str]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/data/version={v}/{col}={k}" for k, v in sorted(parts.items())]
    with_version = StructType([*schema.fields, StructField("version", StringType())])
    return spark.read.schema(with_version).option("basePath", f"{path}/data").parquet(*folders).select(*schema.names)


def read_versions(spark: SparkSession, path: str, schema: StructType, partition_col: str = "dt") -> DataFrame:
    """The table as its newest manifest names it. The reader holds those versions:
    later writes add others and take none away (until :func:`drop_versions`)."""
    return _read(spark, path, schema, partition_col, read_manifest(spark, path)[1])


def upsert_versions(spark: SparkSession, incoming: DataFrame, path: str, keys: list[str], partition_col: str = "dt") -> int:
    """Replace or add the rows of ``incoming`` (unique on ``keys``); returns the manifest number.

    Only partitions that ``incoming`` touches are read and written. Stopping
    before the switch leaves the old rows; a writer that another one has
    overtaken gets :class:`daystream.sinks.manifest.StaleWriter` and can start over. On the driver: one
    entry per partition of the table (a day).
    """
    number, parts = read_manifest(spark, path)
    with staged(spark, incoming, "upsert-incoming") as rows:
        touched = sorted(r[0] for r in rows.select(partition_col).distinct().collect())
        if not touched:
            return number
        stored = _read(spark, path, incoming.schema, partition_col, {k: parts[k] for k in touched if k in parts})
        merged = stored.join(rows.select(*keys), keys, "left_anti").select(*incoming.columns).unionByName(rows)
        version = uuid.uuid4().hex[:12]
        with staged(spark, merged, "upsert-merged") as merged:
            write_clustered(merged, f"{path}/data/version={version}", partition_col, keys)
    commit(spark, path, number + 1, {**parts, **{k: version for k in touched}})
    return number + 1


def drop_versions(spark: SparkSession, path: str) -> list[str]:
    """Delete the versions that the newest manifest doesn't name, once no reader holds them and no writer is at work."""
    number, parts = read_manifest(spark, path)
    live = set(parts.values())
    gone = [f for f in list_folders(spark, f"{path}/data", 1) if f.rsplit("version=", 1)[-1] not in live]
    for f in gone:
        drop_folder(spark, f)
    drop_manifests(spark, path, number)
    return gone
