"""Multi-line CSV files of any size, read by many tasks.

A quoted field may hold line breaks, so whether a line begins a record depends on all
quotes before it in the file.  The files are read as plain lines, which Spark splits
by byte ranges, and the state at the start of a range follows from the number of
quotes in each range before it:

1. One scan counts the quotes of each range: a row per range is shuffled.
2. Running sums of those counts tell for each range whether it starts inside quotes.
3. The lines of a range are put in order and cut into records.  Only the first and the
   last record of a range can run over its end; those fragments, two per range at
   most, are put together across ranges.

Lines are exchanged once, by range.  Each record is then parsed by Spark's own CSV
parser.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_RANGE = ("file", "range")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, range, line, value, quotes): `line` is in file order inside a range."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("line"),
        "value",
        quotes.alias("quotes"),
    )


def _range_starts(lines: DataFrame) -> DataFrame:
    """(file, range, quotes_before, crlf): one row per byte range; `crlf` tells how the file's first line ends."""
    in_file = Window.partitionBy("file")
    earlier = in_file.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counted = lines.groupBy(*_RANGE).agg(
        F.sum("quotes").alias("own"), F.min_by(F.endswith("value", F.lit("\r")), "line").alias("first")
    )
    return counted.select(
        *_RANGE,
        F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("quotes_before"),
        F.max(F.when(F.col("range") == 0, F.col("first"))).over(in_file).alias("crlf"),
    )


def _joined(fragments: Column) -> Column:
    """The values of an array of (place, value), in order, with line feeds between them."""
    return F.array_join(F.transform(F.array_sort(fragments), lambda f: f["value"]), "\n")


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(record): the text of every record of the CSV files, without the header of each.

    Quotes belong to quoted fields only, and one inside a field is doubled, as RFC 4180
    says.  Line ends are LF or CRLF, as the first line of each file ends; CRLF inside quotes
    becomes LF in a file of CRLF lines and stays in others, as Spark's reader has it.  Empty
    lines between records are no records.
    """
    lines = _lines(spark, path)
    in_range = Window.partitionBy(*_RANGE).orderBy("line")
    before = F.coalesce(
        F.sum("quotes").over(in_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    value = F.when(F.col("crlf"), F.regexp_replace("value", "\r$", "")).otherwise(F.col("value"))
    placed = lines.join(_range_starts(lines), [*_RANGE]).select(
        *_RANGE, "line", value.alias("value"), ((F.col("quotes_before") + before) % 2 == 0).alias("begins")
    )
    # Record 0 of a range is what a record of an earlier range left over.
    upto = in_range.rowsBetween(Window.unboundedPreceding, 0)
    numbered = placed.withColumn("number", F.sum(F.col("begins").cast("int")).over(upto))
    entry = F.struct(F.col("line").alias("place"), "value")
    parts = numbered.groupBy(*_RANGE, "number").agg(_joined(F.collect_list(entry)).alias("value"))
    parts = parts.withColumn("last", F.max("number").over(Window.partitionBy(*_RANGE)))

    at_end = (F.col("number") == 0) | (F.col("number") == F.col("last"))
    is_header = (F.col("range") == 0) & (F.col("number") == 1)
    inside = parts.where(~at_end & ~is_header).select("value")

    in_file = Window.partitionBy("file").orderBy("range", "number")
    of_file = in_file.rowsBetween(Window.unboundedPreceding, 0)
    fragments = parts.where(at_end).withColumns({
        "owner": F.sum((F.col("number") > 0).cast("int")).over(of_file),
        "header": is_header,
    })
    piece = F.struct(F.struct("range", "number").alias("place"), "value")
    across = fragments.groupBy("file", "owner").agg(
        _joined(F.collect_list(piece)).alias("value"), F.max("header").alias("header")
    )
    records = inside.unionByName(across.where("NOT header").select("value"))
    return records.select(F.col("value").alias("record")).where("record <> ''")


def read_split_csv(
    spark: SparkSession, path: str, columns: Sequence[str], malformed: str | None = None
) -> DataFrame:
    """CSV files with a header, all columns as text; equal to Spark's multi-line reader.

    `malformed` names one more column: the whole text of a record that does not have a
    field for each column, null for the others.
    """
    names = [*columns, *([malformed] if malformed else [])]
    schema = ", ".join(f"`{c}` string" for c in names)
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    if malformed:
        options["columnNameOfCorruptRecord"] = malformed
    parsed = F.from_csv(F.col("record"), schema, options)
    return csv_records(spark, path).select(parsed.alias("row")).select("row.*")
