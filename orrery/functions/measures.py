"""Predicates and measures shared by the builders and the rule sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orrery.functions.casting import to_day


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


INFINITY = float("inf")


def not_finite(value: Column | str) -> Column:
    """TRUE for NaN and both infinities, NULL for NULL (Spark sorts NaN highest)."""
    return F.abs(_column(value).cast("double")) >= INFINITY


def below_infinity(value: Column | str) -> Column:
    """TRUE for numbers that are neither NaN nor +infinity; a plain, pushable range."""
    return _column(value) < INFINITY


def is_true(condition: Column) -> Column:
    """Three-valued logic closed: NULL counts as false."""
    return F.coalesce(condition, F.lit(False))


def percent_below(price: Column | str, baseline: Column | str) -> Column:
    """How far a price lies below its baseline, in percent of the baseline."""
    base = _column(baseline).cast("double")
    return F.when(base > 0, (base - _column(price)) / base * F.lit(100.0))


def days_late(done: Column | str, due: Column | str) -> Column:
    """Whole days after the due day, 0 when early, NULL while not done."""
    done_day, due_day = to_day(done), to_day(due)
    return F.when(
        done_day.isNotNull() & due_day.isNotNull(),
        F.greatest(F.datediff(done_day, due_day), F.lit(0)),
    )


def tidy(value: Column | str, form) -> Column:
    """TRUE when `form` would leave the value as it is (NULL-safe)."""
    return _column(value).eqNullSafe(form(value))
