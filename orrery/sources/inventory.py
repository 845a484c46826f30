"""File listing, table export with a profile, and format conversion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.sources.tables import overwrite_table


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, length) of every file below `root`; file contents are never read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "length")
    )


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count, column_count), all tables in one Spark job."""
    profile = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(len(df.columns)).alias("column_count"),
        )
        profile = one if profile is None else profile.unionByName(one)
    if profile is None:
        raise ValueError("no tables to profile")
    return profile


def is_log_table(name: str) -> bool:
    return "dq_" in name or "log" in name


def export_tables(
    spark: SparkSession,
    folder: str,
    tables: Sequence[str] | Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Copy tables to parquet (log tables to CSV as well) and return their profile.

    `tables` are names in the catalog (by default all of them) or frames by name.  The
    profile counts the exported copies, where a count reads only file footers.
    """
    if tables is None:
        tables = [t.name for t in spark.catalog.listTables()]
    exported = {}
    for name in tables:
        df = tables[name] if isinstance(tables, Mapping) else spark.table(name)
        target = f"{folder}/{name}.parquet"
        df.write.mode("overwrite").parquet(target)
        if is_log_table(name):
            df.write.mode("overwrite").option("header", True).csv(f"{folder}/audit_logs/{name}")
        exported[name] = spark.read.schema(df.schema).parquet(target)
    return table_profile(exported)


def convert_exports(
    spark: SparkSession,
    folder: str,
    names: Sequence[str],
    fmt: str,
    suffix: str = "",
    database: str | None = None,
) -> list[str]:
    """Turn every exported parquet copy into a table of another format.

    Rows and schema stay the same; the data go from executor to executor.
    """
    created = []
    for name in names:
        table = f"{database}.{name}{suffix}" if database else f"{name}{suffix}"
        overwrite_table(spark.read.parquet(f"{folder}/{name}.parquet"), table, fmt)
        created.append(table)
    return created
