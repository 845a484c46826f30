"""Documents with edge cases; imported by the tests that use them."""

import pytest


@pytest.fixture
def docs(spark):
    """Rows with nulls in every column, blank, repeated and long texts."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(20_000))
    rows = [
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, " \t\n", "en", "a", 3),
        (4, "one", "en", None, 3),
        (5, "one two three four five six seven", None, "a", 33),
        (5, "one two three four five six seven", None, "a", 33),
        (None, "a text without an id", "en", "b", 20),
        (None, None, None, None, None),
        (6, long, "en", "b", len(long)),
        (7, long, "en", "b", len(long)),
        (8, "Ein Satz mit Ümläuten und 🙂 emoji hier", "de", "b", 40),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture
def none(docs):
    return docs.where("false")
