"""Compare two key sets in both directions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MISSING, EXTRA, MATCHED = "missing", "extra", "matched"


def reconcile(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row per different key: in both, only left (missing), only right (extra).

    Both sides are folded to their different keys before the shuffle, and the
    aggregation that follows joins them: one exchange, no join, no hot key.
    """
    sides = (
        left.select(F.col(key), F.lit(1).alias("l"), F.lit(0).alias("r"))
        .unionByName(right.select(F.col(key), F.lit(0).alias("l"), F.lit(1).alias("r")))
        .where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max("l").alias("l"), F.max("r").alias("r"))
    )
    status = (
        F.when(F.col("r") == 0, F.lit(MISSING))
        .when(F.col("l") == 0, F.lit(EXTRA))
        .otherwise(F.lit(MATCHED))
    )
    return sides.select(key, status.alias("status"))


def reconcile_summary(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The four counts of the report: left, right, missing and extra keys."""
    status = F.col("status")
    return reconcile(left, right, key).agg(
        F.count_if(status != EXTRA).alias("left_keys"),
        F.count_if(status != MISSING).alias("right_keys"),
        F.count_if(status == MISSING).alias("missing_keys"),
        F.count_if(status == EXTRA).alias("extra_keys"),
    )


# Buckets whose digests are compared; a side sends a few numbers for each.
DIGEST_BUCKETS = 4096
_KEY = "__key"


def _digests(keys: DataFrame, suffix: str) -> DataFrame:
    """(bucket, rows, sums): order-free, folded inside the tasks, one row per bucket."""
    hashes = keys.select(
        _bucket().alias("bucket"), *(F.xxhash64(F.lit(seed), _KEY).cast("decimal(38,0)").alias(f"h{seed}") for seed in (1, 2))
    )
    return hashes.groupBy("bucket").agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.sum("h1").alias("a"), F.sum("h2").alias("b")).alias(f"digest_{suffix}")
    )


def _bucket():
    return F.pmod(F.xxhash64(_KEY), F.lit(DIGEST_BUCKETS)).cast("int")


def reconcile_unique(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """What `reconcile` returns, for two sides whose keys occur once each.

    Each side is folded to digests of its hash buckets; keys are exchanged and compared
    only in buckets that differ, so two equal sets exchange a few numbers, and sets that
    differ in a few keys as many buckets.  The cost is a second scan of both sides.  Null
    keys are left out.
    """
    left, right = (df.select(F.col(key).alias(_KEY)).where(F.col(_KEY).isNotNull()) for df in (left, right))
    digests = _digests(left, "left").join(_digests(right, "right"), "bucket", "full")
    differ = digests.where(~F.col("digest_left").eqNullSafe(F.col("digest_right"))).select("bucket")
    # At most DIGEST_BUCKETS short rows: a list in the plan, so that no join is needed to pick rows.
    open_buckets = [row["bucket"] for row in differ.collect()]
    is_open = _bucket().isin(open_buckets) if open_buckets else F.lit(False)
    same = left.where(~is_open).select(_KEY, F.lit(MATCHED).alias("status"))
    found = same.unionByName(reconcile(left.where(is_open), right.where(is_open), _KEY))
    return found.withColumnRenamed(_KEY, key)
