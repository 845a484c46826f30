"""Scratch tables and small helpers of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orrery.session import scratch

#: White space that separates words: space and the five ASCII control characters from tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"


def settled(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back; the files go when the application ends."""
    path = scratch(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores added until ``df`` has no such column in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
