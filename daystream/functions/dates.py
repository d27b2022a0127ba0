"""Epoch-millisecond time helpers.

Wall-clock parts are computed in an explicit time zone (default: the
session zone) through TIMESTAMP_NTZ arithmetic, so the result does not
depend on where the executors run.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def session_tz(spark: SparkSession | None = None) -> str:
    spark = spark or SparkSession.getActiveSession()
    return spark.conf.get("spark.sql.session.timeZone", "UTC") if spark else "UTC"


def epoch_ms_of(ts_ntz) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) -> epoch milliseconds, truncating
    sub-millisecond digits."""
    us = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), _col(ts_ntz))
    return F.floor(us / F.lit(1000)).cast("bigint")


def local_wall_clock(ms, tz: str | None = None) -> Column:
    """epoch ms -> TIMESTAMP_NTZ wall clock in ``tz``."""
    utc = F.timestamp_add("MILLISECOND", _col(ms), F.expr(_EPOCH_NTZ))
    return F.convert_timezone(F.lit("UTC"), F.lit(tz or session_tz()), utc)


def dt_of(ms, tz: str | None = None) -> Column:
    """epoch ms -> 'yyyy-MM-dd' in ``tz``."""
    return F.date_format(local_wall_clock(ms, tz), "yyyy-MM-dd")


def hr_of(ms, tz: str | None = None) -> Column:
    """epoch ms -> two-digit hour 'HH' in ``tz``."""
    return F.date_format(local_wall_clock(ms, tz), "HH")


def day_of(ms, tz: str | None = None) -> Column:
    """epoch ms -> TIMESTAMP at local midnight of its calendar day in ``tz``.

    Used as the event-time column of day-keyed streaming state: it is a
    real timestamp (watermarks need one) that is constant within a day.
    """
    midnight = F.date_trunc("day", local_wall_clock(ms, tz)).cast("timestamp_ntz")
    utc_midnight = F.convert_timezone(F.lit(tz or session_tz()), F.lit("UTC"), midnight)
    # NTZ (UTC wall clock) -> instant, independent of the session zone.
    return F.timestamp_millis(epoch_ms_of(utc_midnight))


def age_years(birthday_text, as_of=None, tz: str | None = None) -> Column:
    """Whole years between a 'yyyy-MM-dd' birthday and ``as_of`` (a date
    column, a 'yyyy-MM-dd' string or None for today in ``tz``), as text.

    Uses calendar arithmetic (a 29 February birthday turns one year older
    on 1 March of a common year), not ``months_between / 12``. An
    unparseable birthday gives NULL.
    """
    b = F.try_to_date(_col(birthday_text), "yyyy-MM-dd")
    if as_of is None:
        a = F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(tz or session_tz()),
                                         F.convert_timezone(F.lit(session_tz()), F.lit("UTC"),
                                                            F.localtimestamp())))
    elif isinstance(as_of, str):
        a = F.to_date(F.lit(as_of))
    else:
        a = as_of
    return F.timestamp_diff("YEAR", b, a).cast("string")
