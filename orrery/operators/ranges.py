"""Range buckets: a monotone bucket number for a sort key.

Used where an order has to be known across the whole table (dense keys, medians)
without sending the table through one task.  The split values are literals in the
plan, so a recomputed partition always lands in the same buckets.

They come from a sketch that one job makes: keys are dealt to slots by their hash, and
each slot keeps the key with the smallest hash.  That is a sample of the *different*
keys, however often one of them occurs, and the smallest hashes tell how many there
are.  Sketches of tasks merge slot by slot, so keys are never exchanged.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a task sends on and the driver gets is at most a key for each slot; with more than
# SLOTS / 4 buckets, these hold more keys each instead.
SLOT_BITS = 16
SLOTS = 1 << SLOT_BITS


class RangeBuckets:
    """Split values for an ordered list of columns, taken from a sketch of the keys.

    The number of buckets follows the number of different keys, estimated here, and is
    two at least; `keys_per_bucket` is what one bucket should hold.
    """

    def __init__(self, df: DataFrame, columns: Sequence[str], keys_per_bucket: int):
        self.columns = tuple(columns)
        keys = df.select(*self.columns)
        self._types = [field.dataType for field in keys.schema.fields]
        present = keys.where(F.col(self.columns[0]).isNotNull())
        hashed = present.select(F.struct(*self.columns).alias("key"), F.xxhash64(*self.columns).alias("hash"))
        # The low bits of the hash name the slot, the others order the keys in it.
        rank = F.shiftrightunsigned("hash", SLOT_BITS)
        slots = hashed.groupBy(F.col("hash").bitwiseAND(SLOTS - 1).alias("slot")).agg(
            F.min(F.struct(rank.alias("rank"), "key")).alias("least")
        )
        found = slots.agg(
            F.sum(F.col("least.rank") / 2.0 ** (64 - SLOT_BITS)).alias("ranks"),
            F.array_sort(F.collect_list("least.key")).alias("keys"),
        ).first()
        sample = [tuple(row) for row in found["keys"]]
        self.keys = _different(len(sample), found["ranks"] or 0.0)
        self.wanted = min(max(2, -(-self.keys // keys_per_bucket)), SLOTS // 4)
        cuts = [sample[len(sample) * i // self.wanted] for i in range(1, self.wanted)] if sample else []
        # A cut at the smallest key would leave the first bucket empty.
        self._splits = [cut for cut in dict.fromkeys(cuts) if cut != sample[0]]

    def __len__(self) -> int:
        return len(self._splits) + 1

    def _key(self, values: Sequence[Column]) -> Column:
        if len(values) == 1:
            return values[0]
        return F.struct(*(v.alias(c) for v, c in zip(values, self.columns)))

    def number(self) -> Column:
        """How many split values are <= the row's key: 0 .. len(self) - 1.

        A binary search: halving steps, so the work per row is the logarithm of the
        number of splits.
        """
        if not self._splits:
            return F.lit(0)
        key = self._key([F.col(c) for c in self.columns])
        literals = [
            self._key([F.lit(v).cast(t) for v, t in zip(row, self._types)])
            for row in self._splits
        ]
        splits = F.array(*literals)
        steps = F.array(*(F.lit(1 << k) for k in reversed(range(len(literals).bit_length()))))

        def further(reached: Column, step: Column) -> Column:
            # Beyond the last split there is NULL, which is not reached.
            split = F.get(splits, reached + step - 1)
            return F.when(split <= key, reached + step).otherwise(reached)

        return F.coalesce(F.reduce(steps, F.lit(0), further), F.lit(0))


def _different(filled: int, ranks: float) -> int:
    """Estimated number of different keys: from the filled slots, or, if most are, from
    the smallest hash in each, which is the smaller the more keys a slot has got."""
    if filled < 0.9 * SLOTS:
        return round(-SLOTS * math.log(1 - filled / SLOTS))
    return round(SLOTS * (SLOTS - 1) / (ranks + SLOTS - filled))
