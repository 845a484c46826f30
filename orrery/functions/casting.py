"""Casts that give NULL for bad values and never fail, whatever ANSI mode says."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_int(value: Column | str) -> Column:
    return _column(value).try_cast("int")


def to_double(value: Column | str) -> Column:
    return _column(value).try_cast("double")


def to_time(value: Column | str, pattern: str | None = None) -> Column:
    """Timestamp from text, date or timestamp; `pattern` only applies to text."""
    if pattern is None:
        return _column(value).try_cast("timestamp")
    return F.try_to_timestamp(_column(value), F.lit(pattern))


def to_day(value: Column | str) -> Column:
    return _column(value).try_cast("date")


def to_money(value: Column | str) -> Column:
    """Two decimals; sums of it do not depend on the order of the rows."""
    return _column(value).try_cast("decimal(18,2)")
