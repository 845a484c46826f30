"""Surrogate keys: dense ones in the order of a natural key, and ones that outlive a load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.operators.ranges import RangeBuckets
from orrery.sources.tables import append_table, ensure_table

KEYS_PER_BUCKET = 500_000
_LARGEST = {"int": 2**31 - 1, "bigint": 2**63 - 1}

_BUCKET, _RANK, _BEFORE = "__bucket", "__rank", "__before"


def dense_key(
    df: DataFrame,
    natural_key: str,
    name: str,
    tie_breakers: Sequence[str] = (),
    size_from: DataFrame | None = None,
    keys_per_bucket: int = KEYS_PER_BUCKET,
    key_type: str = "int",
) -> DataFrame:
    """Add `name`: the position of the row in the order of its natural key.

    The table is cut into range buckets, whatever its size; rows are numbered inside
    their bucket, and the only thing that passes through one task is the row count of
    each bucket.  `size_from` is a cheap frame with the same key columns that is
    counted and sampled instead of `df`.  A key beyond `key_type` (int or bigint)
    stops the job.
    """
    order = [natural_key, *tie_breakers]
    buckets = RangeBuckets(df if size_from is None else size_from, order, keys_per_bucket)
    bucketed = df.withColumn(_BUCKET, buckets.number())

    earlier = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    sizes = bucketed.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("__rows"))
    offsets = sizes.select(
        _BUCKET, F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias(_BEFORE)
    )
    inside = Window.partitionBy(_BUCKET).orderBy(*order)
    position = F.col(_BEFORE) + F.col(_RANK)
    too_large = F.raise_error(F.lit(f"{name} does not fit into {key_type}; use bigint"))
    return (
        bucketed.withColumn(_RANK, F.row_number().over(inside))
        .join(offsets, _BUCKET)  # one row per bucket
        .withColumn(
            name,
            F.when(position <= _LARGEST[key_type], position).otherwise(too_large).cast(key_type),
        )
        .drop(_BUCKET, _RANK, _BEFORE)
    )


def new_keys(
    known: DataFrame, df: DataFrame, natural_key: str, name: str, **key_options
) -> DataFrame:
    """(natural_key, name) of the natural keys of `df` that `known` lacks, numbered in their
    order behind its largest key.  Null keys and copies get none."""
    fresh = df.select(natural_key).where(F.col(natural_key).isNotNull()).distinct()
    fresh = fresh.join(known.select(natural_key), natural_key, "left_anti")
    largest = known.agg(F.max(name)).first()[0] or 0
    options = {"size_from": df.select(natural_key), **key_options}
    key_type = options.get("key_type", "int")
    numbered = dense_key(fresh, natural_key, name, **{**options, "key_type": "bigint"})
    position = F.col(name) + largest
    too_large = F.raise_error(F.lit(f"{name} does not fit into {key_type}; use bigint"))
    key = F.when(position <= _LARGEST[key_type], position).otherwise(too_large).cast(key_type)
    return numbered.select(natural_key, key.alias(name))


def kept_keys(
    df: DataFrame, natural_key: str, name: str, key_table: str, fmt: str = "parquet", **key_options
) -> DataFrame:
    """`df` with the key that `key_table` holds for its natural key.

    The table keeps each natural key's number for good; natural keys that it does not have are
    appended first.  What a load no longer brings keeps its number, so it has it again if it
    comes back.  One load of a table at a time; rows without a natural key are left out.
    """
    spark = df.sparkSession
    kind = dict(df.dtypes)[natural_key]
    key_type = key_options.get("key_type", "int")
    ensure_table(spark, key_table, f"`{natural_key}` {kind}, `{name}` {key_type}", fmt)
    fresh = new_keys(spark.table(key_table), df, natural_key, name, **key_options)
    append_table(fresh, key_table, fmt)
    return df.join(spark.table(key_table), natural_key)
