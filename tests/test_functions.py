import datetime

import pytest
from pyspark.sql import functions as F

from orrery.functions import casting, days, measures, text


def evaluate(table, value, make, kind="string"):
    return table(f"v {kind}", (value,)).select(make(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "make, value, expected",
    [
        (text.blank_to_null, "  ", None),
        (text.blank_to_null, " a ", "a"),
        (text.category_key, " Cama__Mesa-Banho ", "cama mesa banho"),
        (text.category_key, "  ", None),
        (lambda c: text.category_key(c, blank="unknown"), None, "unknown"),
        (lambda c: text.category_key(c, blank="unknown"), "", "unknown"),
        (text.display_text, "  Bed_Bath--Table \t top ", "bed bath table top"),
        (text.display_text, "__", None),
        (text.title_words, " bed_bath table ", "Bed_bath Table"),
        (text.title_letters, " bed_bath TABLE 2nd ", "Bed_Bath Table 2Nd"),
        (text.title_letters, "", ""),
        (text.one_line, "a\r\n\nb", "a b"),
        (lambda c: text.after_marker(c, "/Files/"), "x/Files/raw/a.csv", "raw/a.csv"),
        (lambda c: text.after_marker(c, "/Files/"), "raw/a.csv", "raw/a.csv"),
        (casting.to_int, "abc", None),
        (casting.to_int, " 12 ", 12),
        (casting.to_double, "1e3", 1000.0),
        (casting.to_time, "not a date", None),
        (casting.to_day, "2018-02-30", None),
    ],
)
def test_text_and_casts(table, make, value, expected):
    assert evaluate(table, value, make) == expected


@pytest.mark.parametrize(
    "value, expected",
    [(1.0, False), (float("nan"), True), (float("inf"), True), (float("-inf"), True), (None, None)],
)
def test_not_finite(table, value, expected):
    assert evaluate(table, value, measures.not_finite, "double") is expected


@pytest.mark.parametrize(
    "price, baseline, expected", [(15.0, 20.0, 25.0), (25.0, 20.0, -25.0), (5.0, 0.0, None), (5.0, None, None)]
)
def test_percent_below(table, price, baseline, expected):
    df = table("p double, b double", (price, baseline))
    assert df.select(measures.percent_below("p", "b")).first()[0] == expected


@pytest.mark.parametrize(
    "done, due, expected",
    [
        ("2017-11-27 10:00:00", "2017-11-26 10:00:00", 1),
        ("2017-11-25 10:00:00", "2017-11-26 10:00:00", 0),
        (None, "2017-11-26 10:00:00", None),
        ("2017-11-25 10:00:00", None, None),
    ],
)
def test_days_late(table, done, due, expected):
    df = table("a string, b string", (done, due))
    assert df.select(measures.days_late("a", "b")).first()[0] == expected


def test_black_friday_follows_the_fourth_thursday(spark):
    years = spark.range(2000, 2040).select(F.col("id").cast("int").alias("y"))
    for year, day in years.select("y", days.black_friday(F.col("y"))).collect():
        thursdays = [
            d for d in range(1, 31) if datetime.date(year, 11, d).weekday() == 3
        ]
        assert day == datetime.date(year, 11, thursdays[3]) + datetime.timedelta(days=1)
