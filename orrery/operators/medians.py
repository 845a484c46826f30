"""Exact interpolated median per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.operators.ranges import RangeBuckets

# Different values that one range of the histogram should hold.
VALUES_PER_BUCKET = 250_000

_COUNT, _BUCKET = "__count", "__bucket"


def median_per_key(
    df: DataFrame,
    key: str,
    value: str,
    name: str,
    size_from: DataFrame | None = None,
    values_per_bucket: int = VALUES_PER_BUCKET,
) -> DataFrame:
    """One row per `key` with the exact median of the double column `value`.

    Rows are first folded to (key, value, count), which spreads a hot key over its
    values.  The histogram of each key is cut into value ranges, and only the one or
    two ranges that hold the middle are looked into, so a group of any size is spread
    over tasks.  `size_from` is a cheap frame with every value of the column; the
    ranges are cut from the different values in it.
    """
    number = F.col(value).cast("double").alias(value)
    values = (df if size_from is None else size_from).select(number)
    # Without the filter on the key Spark adds it to one of the two branches below, and then
    # computes the folded rows twice instead of reusing their exchange.
    folded = (
        df.where(F.col(value).isNotNull() & F.col(key).isNotNull())
        .groupBy(key, number)
        .agg(F.count(F.lit(1)).alias(_COUNT))
    )

    buckets = RangeBuckets(values, [value], values_per_bucket)
    bucketed = folded.withColumn(_BUCKET, buckets.number())

    # Where do the two middle rows lie?  At most one row per bucket and key here.
    per_key = Window.partitionBy(key)
    running = per_key.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, 0)
    middle = (
        bucketed.groupBy(key, _BUCKET)
        .agg(F.sum(_COUNT).alias("__size"))
        .withColumn("__upto", F.sum("__size").over(running))
        .withColumn("__total", F.sum("__size").over(per_key))
        .withColumn("__before", F.col("__upto") - F.col("__size"))
        .withColumn("__low", F.expr("(__total + 1) div 2") - F.col("__before"))
        .withColumn("__high", F.expr("(__total + 2) div 2") - F.col("__before"))
        .where(_holds("__low", "__size") | _holds("__high", "__size"))
        .select(key, _BUCKET, "__low", "__high")
    )
    # Look up those ranks inside the one or two buckets found for each key.
    in_bucket = (
        Window.partitionBy(key, _BUCKET)
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    found = (
        bucketed.join(middle, [key, _BUCKET])
        .withColumn("__upto", F.sum(_COUNT).over(in_bucket))
        .withColumn("__low", F.col("__low") - F.col("__upto") + F.col(_COUNT))
        .withColumn("__high", F.col("__high") - F.col("__upto") + F.col(_COUNT))
    )
    low = F.max(F.when(_holds("__low", _COUNT), F.col(value)))
    high = F.max(F.when(_holds("__high", _COUNT), F.col(value)))
    return found.groupBy(key).agg((low * 0.5 + high * 0.5).alias(name))


def _holds(rank: str, size: str) -> Column:
    """Does a run of `size` rows contain the row at this 1-based rank?"""
    return F.col(rank).between(F.lit(1), F.col(size))
