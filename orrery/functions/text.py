"""Text clean-up as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_text(value: Column | str) -> Column:
    return _column(value).cast("string")


def stripped(value: Column | str) -> Column:
    return F.trim(as_text(value))


def blank_to_null(value: Column | str) -> Column:
    """Strip; a value with nothing left becomes NULL."""
    return F.nullif(stripped(value), F.lit(""))


def lowered(value: Column | str) -> Column:
    return F.lower(stripped(value))


def uppered(value: Column | str) -> Column:
    return F.upper(stripped(value))


def separators_to_space(value: Column | str) -> Column:
    """Every run of underscores and hyphens becomes one space."""
    return F.regexp_replace(as_text(value), "[_-]+", " ")


def category_key(value: Column | str, blank: str | None = None) -> Column:
    """The form in which category names are joined; `blank` replaces empty names."""
    key = separators_to_space(F.lower(blank_to_null(value)))
    return key if blank is None else F.coalesce(key, F.lit(blank))


def display_text(value: Column | str) -> Column:
    """Lower case words, one space apart; nothing left means NULL."""
    spaced = F.regexp_replace(F.lower(as_text(value)), r"[_\s-]+", " ")
    return blank_to_null(spaced)


def title_words(value: Column | str) -> Column:
    """Capital first letter after each space."""
    return F.initcap(stripped(value))


def title_letters(value: Column | str) -> Column:
    """Capital letter after anything that is not a letter: `bed_bath` -> `Bed_Bath`.

    The text is cut into letter runs and the gaps between them, so that every
    run can be capitalised by a built-in.
    """
    pieces = F.regexp_extract_all(stripped(value), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(pieces, lambda piece: F.initcap(piece)), "")


def one_line(value: Column | str) -> Column:
    """Every run of line breaks becomes one space."""
    return F.regexp_replace(as_text(value), "[\r\n]+", " ")


def after_marker(value: Column | str, marker: str) -> Column:
    """The piece between the first and the second `marker`; without one, the whole."""
    pieces = F.split(as_text(value), _literal_pattern(marker))
    return F.when(F.size(pieces) > 1, F.get(pieces, F.lit(1))).otherwise(as_text(value))


def _literal_pattern(text: str) -> str:
    return "".join(c if c.isalnum() or c in "/_ " else "\\" + c for c in text)
