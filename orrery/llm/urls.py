"""Parts of a URL, as expressions shared by the operators on pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty for null or without one."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host(url: Column) -> Column:
    """Up to the first ``/``, ``?`` or ``#``, A-Z lower-cased; empty for null or without ``://``."""
    return F.translate(F.regexp_extract(_rest(url), r"\A[^/?#]*", 0), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """From the end of the host up to the first ``?`` or ``#``."""
    return F.regexp_extract(_rest(url), r"\A[^/?#]*([^?#]*)", 1)


def query(url: Column) -> Column:
    """After the first ``?``, up to ``#``."""
    return F.regexp_extract(_rest(url), r"\A[^?#]*\?([^#]*)", 1)
