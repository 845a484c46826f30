"""One surviving row per key.

`row_number() = 1` is planned with a group limit on both sides of the exchange:
every task keeps one row per key before anything is shuffled, so a key that holds
a third of the table costs one row per task and not a third of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__survivor_rank"

# Slots that keys are counted in, and the rows from which the keys of a slot are crowded.
SLOTS = 1 << 16
ROWS_PER_SLOT = 1_000_000


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = ()
) -> DataFrame:
    """Keep the first row per key by `order`.

    All remaining columns follow as tie-breakers, so the survivor does not depend
    on partitioning or on a retried task.
    """
    settled = {*keys, *(o for o in order if isinstance(o, str))}
    tie_breakers = [F.col(name) for name in df.columns if name not in settled]
    window = Window.partitionBy(*keys).orderBy(*order, *tie_breakers or [F.lit(1)])
    return (
        df.withColumn(_RANK, F.row_number().over(window))
        .where(F.col(_RANK) == 1)
        .drop(_RANK)
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    """Exact duplicates collapse; duplicates within a task go before the shuffle."""
    return df.distinct()


def distinct_by_key(
    df: DataFrame,
    key: str,
    size_from: DataFrame | None = None,
    rows_per_slot: int = ROWS_PER_SLOT,
) -> list[DataFrame]:
    """`distinct_rows` in one or two parts, for a join on `key` that follows on each of them.

    The first part is dealt by `key` alone, so the join needs no exchange of its own, and
    no task folds rows that have no copies.  Keys with very many rows would land in one
    task that way: they make up the second part, where copies go before the shuffle and
    the join deals the rows, so that it can split them.  Which keys these are is counted
    by hash slot in one job on `size_from`, a cheap frame with every value of the key.
    """
    slot = F.xxhash64(key).bitwiseAND(SLOTS - 1)
    counts = (df if size_from is None else size_from).groupBy(slot.alias("slot")).count()
    crowded = [row["slot"] for row in counts.where(F.col("count") > rows_per_slot).collect()]
    if not crowded:
        return [df.repartition(key).distinct()]
    hot = slot.isin(crowded)
    return [df.where(~hot).repartition(key).distinct(), distinct_rows(df.where(hot))]
