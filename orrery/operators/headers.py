"""Column-name checks and repairs; all of it is driver-side metadata work."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

BYTE_ORDER_MARK = "\ufeff"


def standard_headers(df: DataFrame) -> DataFrame:
    """Strip and lower-case every column name."""
    return df.toDF(*(name.strip().lower() for name in df.columns))


def without_bom(df: DataFrame) -> DataFrame:
    """Remove a byte-order mark and stray spaces from the column names."""
    return df.toDF(*(name.replace(BYTE_ORDER_MARK, "").strip() for name in df.columns))


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return sorted(name for name in required if name not in present)


def require_columns(df: DataFrame, required: Iterable[str], dataset: str) -> DataFrame:
    """Return `df`, or raise a ValueError that names what is missing."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"{dataset}: missing required column(s): {missing}")
    return df


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))
