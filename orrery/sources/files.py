"""CSV and parquet files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery import fixed
from orrery.sources.records import read_split_csv

_QUOTING = {"header": True, "quote": '"', "escape": '"'}


def text_schema(columns: Sequence[str]) -> str:
    """All columns as text: a bad value turns NULL in our cast, not in the reader."""
    return ", ".join(f"`{c}` string" for c in columns)


def read_raw_csv(
    spark: SparkSession, path: str, columns: Sequence[str], malformed: str | None = None
) -> DataFrame:
    """A CSV file with a header; one line is one row, so large files are split.

    A line with too few or too many fields is padded or cut.  `malformed` names one more
    column that tells: it holds the whole text of such a line, and null for the others.
    """
    if malformed is None:
        return spark.read.schema(text_schema(columns)).options(**_QUOTING).csv(path)
    # Without column pruning, or a query of two columns would not see that a third is gone.
    reader = spark.read.schema(text_schema([*columns, malformed])).options(**_QUOTING)
    lines = reader.options(columnNameOfCorruptRecord=malformed, columnPruning=False).csv(path)
    # Spark refuses a query of this column alone; tied to the others it may be asked for by itself.
    read = F.length(F.concat_ws("", *[F.col(f"`{c}`") for c in columns])) >= 0
    return lines.withColumn(malformed, F.when(read, F.col(malformed)))


def read_raw_order_payments(
    spark: SparkSession, input_path: str, malformed: str | None = None
) -> DataFrame:
    return read_raw_csv(spark, input_path, fixed.PAYMENT_COLUMNS, malformed)


def load_reviews(
    spark: SparkSession,
    path: str,
    line_breaks: bool = True,
    splittable: bool = False,
    malformed: str | None = None,
) -> DataFrame:
    """Reviews; a quoted comment may run over several lines.

    Spark reads such a file in one task.  `splittable` reads it in parts of any number,
    for one exchange of its lines; many files of moderate size need no such thing, nor
    do files in which no comment has `line_breaks`.  `malformed` names a column for the
    text of records that do not have a field for each column (parts of files only).
    """
    if splittable:
        return read_split_csv(spark, path, fixed.REVIEW_COLUMNS, malformed)
    if malformed:
        raise ValueError("malformed records are kept where splittable is set")
    reader = spark.read.schema(text_schema(fixed.REVIEW_COLUMNS))
    return reader.options(**_QUOTING, multiLine=line_breaks, encoding="UTF-8").csv(path)
