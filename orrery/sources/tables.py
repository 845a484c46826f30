"""Catalog tables: read, create, append, overwrite, publish after a check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def ensure_table(spark: SparkSession, name: str, schema: str, fmt: str = "parquet") -> None:
    """CREATE TABLE IF NOT EXISTS with a declared schema."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({schema}) USING {fmt}")


def append_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("append").saveAsTable(name)


def overwrite_table(
    df: DataFrame, name: str, fmt: str = "parquet", replace_schema: bool = False
) -> None:
    """Replace the content of a table; `replace_schema` matters to lakehouse formats,
    a parquet table takes the new schema anyway."""
    writer = df.write.format(fmt).mode("overwrite")
    if replace_schema:
        writer = writer.option("overwriteSchema", "true")
    writer.saveAsTable(name)


def write_path(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("overwrite").save(path)


def publish_table(
    df: DataFrame,
    name: str,
    check: Callable[[DataFrame], object] | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Write once, check what was written, and only then make it the table.

    The plan runs one time.  The check reads the finished staging table, so it scans
    narrow columns instead of running the joins again, and a check that raises leaves
    the published table as it was.  The old table is renamed aside and dropped last:
    a publish that dies between its steps leaves a complete table under one of the two
    names, and `recover_table`, which the next publish calls first, puts it back.
    """
    spark = df.sparkSession
    staging, aside = _staging(name), _aside(name)
    recover_table(spark, name)
    _drop(spark, staging)
    overwrite_table(df, staging, fmt)
    if check is not None:
        check(spark.table(staging))
    if spark.catalog.tableExists(name):
        _rename(spark, name, aside)
    _rename(spark, staging, name)
    _drop(spark, aside)
    return spark.table(name)


def recover_table(spark: SparkSession, name: str) -> bool:
    """Undo or finish a publish that was cut off; True if there was something to do."""
    aside = _aside(name)
    if not spark.catalog.tableExists(aside):
        return False
    if spark.catalog.tableExists(name):
        _drop(spark, aside)
    else:
        _rename(spark, aside, name)
    return True


def _staging(name: str) -> str:
    return f"{name}__staging"


def _aside(name: str) -> str:
    return f"{name}__before"


def _drop(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")


def _rename(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {_quoted(old)} RENAME TO {_quoted(new)}")


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))
