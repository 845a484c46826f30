"""Quality log tables and the summary made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery import fixed
from orrery.sources.tables import append_table, ensure_table, overwrite_table


# -------------------------------------------------------------------- writing
def log_row_count(
    spark: SparkSession,
    dataset: str,
    stage: str,
    count: int,
    table: str = fixed.LOG_TABLES["rowcount"],
    fmt: str = "parquet",
) -> None:
    """Append one (dataset, stage, row_count, log_timestamp) row."""
    row = spark.range(1).select(
        F.lit(dataset).alias("dataset"),
        F.lit(stage).alias("stage"),
        F.lit(int(count)).cast("bigint").alias("row_count"),
        F.current_timestamp().alias("log_timestamp"),
    )
    ensure_table(spark, table, fixed.ROWCOUNT_LOG_SCHEMA, fmt)
    append_table(row, table, fmt)


def log_invalid_summary(
    spark: SparkSession,
    dataset: str,
    view: str = "all_invalid",
    table: str = fixed.LOG_TABLES["invalid_summary"],
    fmt: str = "parquet",
) -> int:
    """Append the number of rows of `view`; a view that does not exist counts as 0."""
    exists = spark.catalog.tableExists(view)
    count = spark.table(view).count() if exists else 0
    row = spark.range(1).select(
        F.lit(dataset).alias("dataset"),
        F.lit(count).cast("bigint").alias("invalid_rows"),
        F.current_timestamp().alias("log_timestamp"),
    )
    ensure_table(spark, table, fixed.INVALID_SUMMARY_SCHEMA, fmt)
    append_table(row, table, fmt)
    return count


def log_invalid_rows(
    dataset: str,
    invalid: DataFrame,
    table: str = fixed.LOG_TABLES["invalid_rows"],
    fmt: str = "parquet",
) -> None:
    """Append (dataset, column_name, rule, invalid_value, log_timestamp) rows.

    `invalid` is what `RuleSet.invalid_rows` gives; it is written as it is computed.
    """
    rows = invalid.select(
        F.lit(dataset).alias("dataset"),
        "column_name",
        "rule",
        F.col("invalid_value").cast("string").alias("invalid_value"),
        F.current_timestamp().alias("log_timestamp"),
    )
    ensure_table(invalid.sparkSession, table, fixed.INVALID_ROWS_SCHEMA, fmt)
    append_table(rows, table, fmt)


# -------------------------------------------------------------------- summary
def _newest(stage: str) -> Column:
    """Newest logged count of a stage (time first, then count)."""
    entry = F.struct("log_timestamp", "row_count")
    return F.max(F.when(F.col("stage") == stage, entry))["row_count"]


def latest_counts(rowcounts: DataFrame) -> DataFrame:
    """Newest logged count per dataset for the two stages, side by side.

    The newest row is picked by an aggregate, so a dataset with a long history is
    folded within each task before the shuffle.
    """
    return rowcounts.groupBy("dataset").agg(
        _newest(fixed.STAGE_BEFORE).alias("silver_before"),
        _newest(fixed.STAGE_AFTER).alias("silver_after"),
    )


def dq_summary(
    rowcounts: DataFrame, invalid: DataFrame, latest_only: bool = False
) -> DataFrame:
    """One row per dataset of `rowcounts`: counts, dropped rows, invalid rows, verdict.

    Both logs are folded by one grouping.  Invalid rows are added up over the whole
    log; `latest_only` takes the newest entry of each dataset instead.
    """
    counted = rowcounts.select("dataset", "stage", "row_count", "log_timestamp")
    noted = invalid.select("dataset", "invalid_rows", "log_timestamp")
    logs = counted.unionByName(noted, allowMissingColumns=True)
    if latest_only:
        entry = F.struct("log_timestamp", "invalid_rows")
        total = F.max(F.when(F.col("invalid_rows").isNotNull(), entry))["invalid_rows"]
    else:
        total = F.sum("invalid_rows")
    folded = logs.groupBy("dataset").agg(
        _newest(fixed.STAGE_BEFORE).alias("silver_before"),
        _newest(fixed.STAGE_AFTER).alias("silver_after"),
        total.alias("invalid_rows"),
        F.count("stage").alias("__entries"),
    )
    return folded.where("__entries > 0").select(
        "dataset",
        "silver_before",
        "silver_after",
        (F.col("silver_before") - F.col("silver_after")).alias("dropped_rows"),
        "invalid_rows",
        (F.col("silver_after") > 0).alias("dq_pass"),
    )


def generate_dq_summary(
    spark: SparkSession, latest_only: bool = False, fmt: str = "parquet"
) -> DataFrame:
    """Rebuild the summary table from the two log tables."""
    names = fixed.LOG_TABLES
    ensure_table(spark, names["rowcount"], fixed.ROWCOUNT_LOG_SCHEMA, fmt)
    ensure_table(spark, names["invalid_summary"], fixed.INVALID_SUMMARY_SCHEMA, fmt)
    summary = dq_summary(
        spark.table(names["rowcount"]), spark.table(names["invalid_summary"]), latest_only
    ).withColumn("log_timestamp", F.current_timestamp())
    overwrite_table(summary, names["summary"], fmt)
    return spark.table(names["summary"])
