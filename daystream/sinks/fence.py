"""Run numbers that order saves without clocks.

A run takes the next number of a table when it starts (the table's manifest,
:mod:`daystream.sinks.manifest`); from then on every earlier run is fenced off:
its saves are refused, and rows it managed to write before it noticed order
behind those of the later run.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from daystream.sinks.manifest import StaleWriter, commit, read_manifest


def begin_run(spark: SparkSession, path: str) -> int:
    """The next run number of the table at ``path``; numbers start at 1."""
    while True:
        number = read_manifest(spark, path)[0] + 1
        try:
            commit(spark, path, number, {"run": number})
        except StaleWriter:
            continue  # another run took it; so take the one after
        return number


def check_run(spark: SparkSession, path: str, run: int) -> None:
    """Raise :class:`StaleWriter` if a later run has begun."""
    newest = read_manifest(spark, path)[0]
    if newest != run:
        raise StaleWriter(f"run {run} of {path} was overtaken by run {newest}")
