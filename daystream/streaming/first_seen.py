"""First page of each (day, device) with keyed state that ends with its day."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from daystream import schemas
from daystream.functions.dates import day_of, dt_of
from daystream.sinks.upsert import list_folders, read_table, table_exists

#: Name of the state variable, for :func:`seen_state`.
SEEN = "seen"
_DAY_MS = "day_ms"
_POSITION = tuple(schemas.POSITION_COLS)
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# The engine starts the processor in a Python process of its own that gets no files
# of ``addPyFile`` or ``--py-files``, so it travels with its code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@contextmanager
def keyed_state(spark: SparkSession):
    """Queries started in the block keep their state in RocksDB, whatever the session's
    own provider: the default one has no room for timers beside the values. (A query
    copies the settings of its session when it is started.)"""
    old = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, old)


class FirstSeen(StatefulProcessor):
    """One page per key ``(dt, mid)``: the earliest by ``(ts, position)`` of the
    micro-batch in which the key is met first.

    A value state per key remembers the time of the counted page; an
    event-time timer clears it once the watermark has passed the key's day.
    Pages of a day that the watermark, or ``horizon_ms``, has passed are *late*: the
    state doesn't know their keys, so the earliest of each batch comes out with
    ``late`` set, and the caller asks the stored result. Nothing is dropped.
    """

    def __init__(self, columns: list[str], horizon_ms: int = 0):
        self.columns = columns
        self.horizon_ms = horizon_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getValueState(SEEN, StructType([StructField("ts", LongType())]))

    def _remember(self, ts: int, day_ms: int) -> None:
        self.seen.update((ts,))
        self.handle.registerTimer(day_ms + 1)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first = min(rows, key=lambda r: (r["ts"], *(r[c] for c in _POSITION)))
        late = first[_DAY_MS] < max(timerValues.getCurrentWatermarkInMs(), self.horizon_ms)
        if not late:
            if self.seen.exists():
                return
            self._remember(first["ts"], first[_DAY_MS])
        yield Row(**{c: first[c] for c in self.columns}, late=late)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self._remember(initialState["ts"], initialState[_DAY_MS])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def _with_day_ms(df: DataFrame, tz: str | None) -> DataFrame:
    return df.withColumn(_DAY_MS, F.unix_millis(day_of("ts", tz)))


def horizon_of(spark: SparkSession, dau_path: str, watermark: str, tz: str | None = None) -> int:
    """Local midnight (ms) ``watermark`` before the newest stored day, 0 without one.

    Found from the names of the day folders. Stored days before it aren't
    loaded into the state; their pages are late.
    """
    days = [f.rsplit("dt=", 1)[-1] for f in list_folders(spark, dau_path, 1) if "/dt=" in f]
    if not days:
        return 0
    zone = tz or spark.conf.get("spark.sql.session.timeZone")
    midnight = f"to_timestamp('{max(days)} 00:00:00 {zone}', 'yyyy-MM-dd HH:mm:ss VV') - interval {watermark}"
    return int(spark.range(1).select(F.unix_millis(F.expr(midnight))).first()[0])


def stored_keys(spark: SparkSession, dau_path: str, horizon_ms: int, tz: str | None = None) -> DataFrame:
    """(dt, mid, ts, day_ms) of the stored days from ``horizon_ms`` on (partition filter), for the initial state."""
    if not table_exists(spark, dau_path):
        return spark.createDataFrame([], f"dt string, mid string, ts long, {_DAY_MS} long")
    stored = read_table(spark, dau_path, schemas.DAU_INFO).select("dt", "mid", "ts")
    first_day = spark.range(1).select(dt_of(F.lit(horizon_ms), tz)).first()[0]
    return _with_day_ms(stored.where(F.col("dt") >= first_day), tz)


def first_seen_stream(pages: DataFrame, watermark: str, tz: str | None = None,
                      dau_path: str | None = None) -> DataFrame:
    """Streaming pages -> the first page per ``(dt, mid)``, with ``dt`` and ``late``.

    ``dau_path``: the stored result, whose keys within ``watermark`` of its newest day
    are the initial state of a new checkpoint (an old checkpoint has its own
    state, and the engine doesn't read them again). The event-time column
    moves the watermark and is dropped before the state: the engine refuses
    rows by that column, and here late ones must go on.
    """
    spark = pages.sparkSession
    usable = pages.where(F.col("mid").isNotNull() & F.col("ts").isNotNull())
    marked = (_with_day_ms(usable, tz).withColumn("dt", dt_of("ts", tz)).withColumn("day", day_of("ts", tz))
              .withWatermark("day", watermark).drop("day"))
    out = StructType([f for f in marked.schema if f.name != _DAY_MS] + [StructField("late", BooleanType())])
    horizon, initial = 0, None
    if dau_path is not None:
        horizon = horizon_of(spark, dau_path, watermark, tz)
        initial = stored_keys(spark, dau_path, horizon, tz).groupBy("dt", "mid")
    return marked.groupBy("dt", "mid").transformWithState(
        FirstSeen([f.name for f in out][:-1], horizon), out, "append", "eventTime", initial)


def seen_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The keys in the state of a query, ``(dt, mid, ts)``, read with the state data source."""
    state = spark.read.format("statestore").option("stateVarName", SEEN).load(checkpoint)
    return state.select("key.dt", "key.mid", "value.ts")
