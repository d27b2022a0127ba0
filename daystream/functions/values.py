"""Lenient field access on parsed JSON (string leaves)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_long(c) -> Column:
    """Field as long: accepts numbers and quoted numbers (surrounding blanks
    allowed); fractions, separators and words give NULL instead of failing
    the job."""
    return _col(c).try_cast("bigint")


def is_blank(c) -> Column:
    """NULL, empty or whitespace-only text."""
    c = _col(c)
    return c.isNull() | ~c.rlike(r"\S")
