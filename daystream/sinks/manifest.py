"""Numbered manifests: what a table consists of, switched by one small file.

A writer puts data into folders that no manifest names yet, and then creates
the next manifest. Readers use the newest whole one, so they see a change or
not, never half of it. Creating a number that is there already fails: the
second of two writers loses its turn instead of the other's rows.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from daystream.sinks.upsert import _fs


class StaleWriter(RuntimeError):
    """Another writer has switched the table since this one read it."""


def _folder(path: str) -> str:
    return f"{path}/_manifest"


def read_manifest(spark: SparkSession, path: str) -> tuple[int, dict]:
    """(number, content) of the newest manifest, (0, {}) if there is none. One
    that is still being written isn't whole JSON yet and doesn't count."""
    p, fs = _fs(spark, _folder(path))
    if not fs.exists(p):
        return 0, {}
    names = sorted((f.getPath().getName() for f in fs.listStatus(p) if f.getPath().getName().endswith(".json")), reverse=True)
    for name in names:
        stream = fs.open(_fs(spark, f"{_folder(path)}/{name}")[0])
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return int(name.split(".")[0]), json.loads(text)
        except ValueError:
            continue
    return 0, {}


def commit(spark: SparkSession, path: str, number: int, content: dict) -> None:
    """Create manifest ``number`` (one more than the one that was read)."""
    p, fs = _fs(spark, f"{_folder(path)}/{number:012d}.json")
    try:
        out = fs.create(p, False)
    except Exception as e:
        if fs.exists(p):
            raise StaleWriter(f"{path} has manifest {number} already") from e
        raise
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()


def drop_manifests(spark: SparkSession, path: str, before: int) -> None:
    """Delete manifests older than number ``before``."""
    p, fs = _fs(spark, _folder(path))
    for f in fs.listStatus(p):
        if int(f.getPath().getName().split(".")[0]) < before:
            fs.delete(f.getPath(), False)
