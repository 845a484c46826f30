"""Calendar attributes as Column expressions over one date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orrery import fixed


def date_key(day: Column) -> Column:
    """20171124 for 2017-11-24."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def black_friday(year: Column) -> Column:
    """The day after the fourth Thursday of November.

    `next_day` of 31 October is the first Thursday of November.
    """
    first_thursday = F.next_day(F.make_date(year, F.lit(10), F.lit(31)), "Thu")
    return F.date_add(first_thursday, 3 * 7 + 1)


def _choose(labels, *conditions: Column) -> Column:
    """First label whose condition holds, the last label otherwise."""
    chosen = F.lit(labels[-1])
    for label, condition in reversed(list(zip(labels, conditions))):
        chosen = F.when(condition, F.lit(label)).otherwise(chosen)
    return chosen


def period_number(day: Column, study_year: int) -> Column:
    """1 before, 2 during, 3 after the study year's Black Friday days, 4 elsewhere."""
    offset = F.datediff(day, black_friday(F.lit(study_year)))
    event_end = fixed.EVENT_DAYS - 1
    return _choose(
        (1, 2, 3, 4),
        offset.between(-fixed.BEFORE_DAYS, -1),
        offset.between(0, event_end),
        offset.between(event_end + 1, event_end + fixed.AFTER_DAYS),
    )


def calendar_attributes(day: Column, study_year: int = fixed.STUDY_YEAR) -> dict[str, Column]:
    """All columns of the date dimension, each a function of `day` alone."""
    distance = F.datediff(day, black_friday(F.year(day)))
    number = period_number(day, study_year)
    group = _choose((1, 2, 3), number == 2, number != 4)
    weekday = F.dayofweek(day)
    columns = {
        "date_key": date_key(day),
        "date": day,
        "year": F.year(day),
        "month": F.month(day),
        "dow": weekday,
        "is_black_friday": _choose(fixed.BLACK_FRIDAY_LABELS, distance == 0),
        "event_window": _choose(
            fixed.WINDOW_LABELS, F.abs(distance) <= fixed.EVENT_WINDOW_DAYS
        ),
        "is_weekend": _choose(fixed.WEEKEND_LABELS, weekday.isin(1, 7)),
        "event_period": _choose(fixed.PERIOD_LABELS, number == 1, number == 2, number == 3),
        "event_period_sort": number,
        "period_group": _choose(fixed.GROUP_LABELS, group == 1, group == 2),
        "period_group_sort": group,
    }
    return {name: columns[name] for name in fixed.DIM_DATE_COLUMNS}
