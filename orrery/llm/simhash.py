"""Near duplicates by SimHash fingerprints, found with a self-join of binary tries.

Fingerprints that differ in at most ``budget`` bits are linked. Cut into ``budget + 1`` blocks, two linked
fingerprints agree on one block at least, so each fingerprint is stored in one trie per block, rotated to
begin with that block. Tries of different block values never meet. Inside a trie, node pairs are walked
together from the root: differing bits add up, and a pair beyond the budget is dropped with all below it.

Only different fingerprints enter the tries: copies are folded to one row before the shuffle. A block value
with more than ``PER_TRIE`` fingerprints is split into node pairs of its next levels, which are tasks of
their own, so no task has to hold a large trie. What leaves a task are links from each fingerprint to the
smallest one it was joined to there, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.llm.common import free_name, settled, table
from orrery.llm.components import components

WIDTH = 3
SEED = 42
BUDGET = 3
PER_TRIE = 200_000
#: Node pairs walked at once, pairs of leaves compared at once, rows read before tries are joined.
PAIRS_AT_ONCE = 1 << 20
LEAF = 64
ROWS_AT_ONCE = 1 << 17
HASHES_AT_ONCE = 1 << 17


def shingles(text: str | None, width: int = WIDTH) -> list[bytes]:
    """Overlapping word groups, A-Z lower-cased; the whole sequence if shorter; none without a word."""
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)))


def majority_bits(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For runs of ``hashes`` of the given sizes: the bits set in over half of each run; 0 for an empty run."""
    out = np.zeros(len(sizes), np.uint64)
    full = sizes > 0
    if not full.any():
        return out
    starts = (np.cumsum(sizes) - sizes)[full]
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    set_in = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
    over = 2 * set_in > sizes[full][:, None]
    out[full] = np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()
    return out


def _fingerprint_texts(texts: list[str | None], width: int, seed: int) -> np.ndarray:
    out, hashes, sizes = [], [], []
    digest = xxhash.xxh64_intdigest

    def flush() -> None:
        out.append(majority_bits(np.array(hashes, np.uint64), np.array(sizes, np.int64)))
        hashes.clear()
        sizes.clear()

    for text in texts:
        found = shingles(text, width)
        hashes.extend([digest(s, seed) for s in found])
        sizes.append(len(found))
        if len(hashes) >= HASHES_AT_ONCE:
            flush()
    flush()
    return np.concatenate(out)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, seed: int = SEED, keep: str | None = None) -> DataFrame:
    """(id, fp, ``keep``): the SimHash of each row's whole text as a signed 64-bit number. No row is dropped.

    A null or empty text, or one of white space only, gets fingerprint 0. Other columns are left out.
    """
    field = docs.schema[id_col]
    schema = T.StructType([T.StructField(id_col, field.dataType), T.StructField("fp", T.LongType()), *([docs.schema[keep]] if keep else [])])
    names = schema.names

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = _fingerprint_texts(b.column(1).to_pylist(), width, seed)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64)), *b.columns[2:]], names)

    return docs.select(F.col(id_col), F.col(text_col).cast("string"), *([keep] if keep else [])).mapInArrow(of_batches, schema)


def _leaf_pairs(vals, alo, ahi, blo, bhi, same, budget):
    """Index pairs of linked fingerprints among small node pairs, compared directly."""
    na, nb = ahi - alo, bhi - blo
    n = na * nb
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    width = np.repeat(nb, n)
    i = np.repeat(alo, n) + at // width
    j = np.repeat(blo, n) + at % width
    keep = ~np.repeat(same, n) | (i < j)
    i, j = i[keep], j[keep]
    near = np.bitwise_count(vals[i] ^ vals[j]) <= budget
    return i[near], j[near]


class _Joined:
    """Which positions have been joined; labels are the smallest position reached."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        label = self.label
        while True:
            a, b = label[i], label[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up


def join_tries(vals: np.ndarray, nodes: tuple[np.ndarray, ...], top_bit: int, budget: int) -> np.ndarray:
    """Labels after walking node pairs of the tries that sorted runs of ``vals`` are.

    ``nodes``: arrays (alo, ahi, blo, bhi, diff, same); a node is a run of ``vals`` with one prefix, ``diff``
    the differing bits so far, ``same`` marks a node paired with itself. ``top_bit`` is the next bit to split on.
    """
    joined = _Joined(len(vals))
    stack = [(top_bit, nodes)]
    splits: dict[int, np.ndarray] = {}
    while stack:
        bit, pairs = stack.pop()
        if len(pairs[0]) > PAIRS_AT_ONCE:
            half = len(pairs[0]) // 2
            stack += [(bit, tuple(x[:half] for x in pairs)), (bit, tuple(x[half:] for x in pairs))]
            continue
        alo, ahi, blo, bhi, diff, same = pairs
        live = (diff <= budget) & (ahi > alo) & (bhi > blo) & ~(same & (ahi - alo < 2))
        alo, ahi, blo, bhi, diff, same = (x[live] for x in (alo, ahi, blo, bhi, diff, same))
        if not len(alo):
            continue
        small = ((ahi - alo) * (bhi - blo) <= LEAF) | (bit < 0)
        if small.any():
            s = np.flatnonzero(small)
            for part in np.array_split(s, max(1, len(s) // 100_000)):
                joined.add(*_leaf_pairs(vals, alo[part], ahi[part], blo[part], bhi[part], same[part], budget))
        alo, ahi, blo, bhi, diff, same = (x[~small] for x in (alo, ahi, blo, bhi, diff, same))
        if not len(alo):
            continue
        if bit not in splits:
            zero = ((vals >> np.uint64(bit)) & np.uint64(1)) == 0
            splits[bit] = np.concatenate([[0], np.cumsum(zero)])
        z = splits[bit]
        am, bm = alo + z[ahi] - z[alo], blo + z[bhi] - z[blo]
        other = ~same
        children = (
            (alo, am, blo, bm, diff, same),
            (am, ahi, bm, bhi, diff, same),
            (alo, am, bm, bhi, diff + 1, np.zeros_like(same)),
            (am[other], ahi[other], blo[other], bm[other], diff[other] + 1, same[other]),
        )
        stack.append((bit - 1, tuple(np.concatenate(x) for x in zip(*children, strict=True))))
    return joined.label


def _tries_of(rows: dict[str, np.ndarray], budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, smallest fingerprint of its group) of complete tries; rows come sorted by trie, then value."""
    vals, fps = rows["val"].view(np.uint64), rows["fp"]
    names = ("turn", "block", "a", "b")
    new = np.concatenate([[True], np.any([rows[n][1:] != rows[n][:-1] for n in names], axis=0)])
    start = np.flatnonzero(new)
    stop = np.concatenate([start[1:], [len(vals)]])
    left, right = [], []

    def keep(lo: int, label: np.ndarray) -> None:
        # Every task names a group by its smallest fingerprint, so that tasks agree where they can.
        own = fps[lo : lo + len(label)]
        least = own.copy()
        np.minimum.at(least, label, own)
        moved = least[label] != own
        left.append(own[moved])
        right.append(least[label][moved])

    levels = rows["levels"][start]
    whole = levels == 0
    if whole.any():
        lo, hi = start[whole], stop[whole]
        first = 63 - 64 // (budget + 1)
        keep(0, join_tries(vals, (lo, hi, lo, hi, np.zeros(len(lo), np.int64), np.ones(len(lo), bool)), first, budget))
    for k in np.flatnonzero(~whole):
        lo, hi, depth = start[k], stop[k], int(levels[k])
        v = vals[lo:hi]
        first = 63 - 64 // (budget + 1) - depth
        node = (v >> np.uint64(first + 1)) & np.uint64((1 << depth) - 1)
        a, b = int(rows["a"][lo]), int(rows["b"][lo])
        mid = int(np.count_nonzero(node == a))
        one = lambda x, kind=np.int64: np.array([x], kind)
        pair = (0, len(v), 0, len(v)) if a == b else (0, mid, mid, len(v))
        nodes = (*map(one, pair), one((a ^ b).bit_count()), one(a == b, bool))
        keep(lo, join_tries(v, nodes, first, budget))
    return np.concatenate(left), np.concatenate(right)


def links(fps: DataFrame, budget: int = BUDGET, per_trie: int = PER_TRIE) -> DataFrame:
    """(u, v): a forest that joins every two fingerprints of ``fps`` (column fp, distinct) within ``budget`` bits."""
    blocks = budget + 1
    size = 64 // blocks
    turned = F.explode(F.array(*[F.struct(F.lit(r).alias("turn"), (F.shiftleft("fp", size * r).bitwiseOR(F.shiftrightunsigned("fp", 64 - size * r)) if r else F.col("fp")).alias("val")) for r in range(blocks)]))
    rows = fps.select("fp", turned.alias("t")).select("fp", "t.turn", "t.val").withColumn("block", F.shiftrightunsigned("val", 64 - size))
    # At most blocks * 2**size rows, whatever the input: small enough to broadcast for 16-bit blocks.
    crowded = rows.groupBy("turn", "block").count().where(F.col("count") > per_trie)
    crowded = crowded.withColumn("levels", F.least(F.lit(16), F.ceil(F.log2(F.col("count") / per_trie))).cast("int"))
    masks = F.expr(f"filter(sequence(0L, shiftleft(1L, levels) - 1L), m -> bit_count(m) <= {budget})")
    crowded = F.broadcast(crowded.select("turn", "block", "levels", masks.alias("masks")))
    rows = rows.join(crowded, ["turn", "block"], "left").withColumn("levels", F.coalesce("levels", F.lit(0)))
    own = F.expr(f"shiftrightunsigned(val, {64 - size} - levels) & (shiftleft(1L, levels) - 1L)")
    rows = rows.withColumn("own", own).withColumn("mask", F.explode(F.coalesce("masks", F.array(F.lit(0).cast("long")))))
    other = F.col("own").bitwiseXOR(F.col("mask"))
    rows = rows.select("turn", "block", F.least("own", other).alias("a"), F.greatest("own", other).alias("b"), "levels", "val", "fp")
    keys = ["turn", "block", "a", "b"]
    # Values sort as unsigned numbers: the sign bit is turned for the sort only.
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, F.col("val").bitwiseXOR(F.lit(-(2**63)).cast("long")))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(part: dict[str, np.ndarray]) -> pa.RecordBatch:
            u, v = _tries_of(part, budget)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        held: list[dict[str, np.ndarray]] = []
        n = 0
        for batch in batches:
            held.append({c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names})
            n += batch.num_rows
            if n >= ROWS_AT_ONCE:
                part = {c: np.concatenate([h[c] for h in held]) for c in held[0]}
                last = np.flatnonzero(np.any([part[c] != part[c][-1] for c in keys], axis=0))
                cut = last[-1] + 1 if len(last) else 0
                if cut:
                    yield done({c: x[:cut] for c, x in part.items()})
                held = [{c: x[cut:] for c, x in part.items()}]
                n = n - cut if n - cut < ROWS_AT_ONCE else 0
        if held and len(held[0]["fp"]):
            yield done({c: np.concatenate([h[c] for h in held]) for c in held[0]})

    return rows.mapInArrow(of_batches, "u long, v long")


def _classes(docs: DataFrame, id_col: str, text_col: str, budget: int, per_trie: int) -> tuple[DataFrame, DataFrame]:
    """(id, fp, text_hash) of each row, and (fp, root) of each fingerprint."""
    hashed = free_name(docs, "text_hash")
    marked = settled(fingerprints(docs.withColumn(hashed, F.xxhash64(text_col)), id_col, text_col, keep=hashed).withColumnRenamed(hashed, "text_hash"))
    fps = settled(marked.select("fp").distinct())
    reached = components(links(fps, budget, per_trie))
    return marked, settled(fps.join(reached.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = BUDGET, per_trie: int = PER_TRIE) -> DataFrame:
    """(id, fp, component_id): each row with the smallest id that it can reach over links, its own included.

    Texts: null, empty and blank ones have fingerprint 0 and are linked like any other. Rows with a null id
    keep their row; they count for reachability but never name a component (null if all its ids are null).
    Repeated rows stay. An empty table gives an empty result. Other columns are left out.
    """
    marked, roots = _classes(docs, id_col, text_col, budget, per_trie)
    least = marked.groupBy("fp").agg(F.min(id_col).alias("least"))
    named = roots.join(least, "fp").groupBy("root").agg(F.min("least").alias("component_id"))
    # A copy group lies on one key of this join; its other side has one row per key, so AQE can split it.
    return marked.drop("text_hash").join(roots.join(named, "root").select("fp", "component_id"), "fp")


def first_of_each(docs: DataFrame, marked: DataFrame, roots: DataFrame, id_col: str, text_col: str, key: str = "fp") -> DataFrame:
    """The rows of ``docs`` that lead the groups of ``roots`` (key, root); ``marked`` has (id, text_hash, key) of each row.

    Null ids come last. Among rows with one id and group the smallest text hash stays, and of rows that
    also agree in text one with the smallest hash of all columns (of equal rows, any).
    """
    lead = marked.groupBy(key).agg(F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "text_hash")).alias("lead"))
    lead = roots.join(lead, key).groupBy("root").agg(F.min("lead").alias("lead")).select("lead.id", "lead.text_hash").distinct()
    names = {c: free_name(docs, f"{c}_") for c in ("id", "text_hash", "at")}
    lead = lead.withColumnsRenamed(names)
    same = F.col(id_col).eqNullSafe(F.col(names["id"])) & (F.xxhash64(text_col) == F.col(names["text_hash"]))
    plain = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    first = Window.partitionBy(names["id"], names["text_hash"]).orderBy(F.xxhash64(*plain))
    found = docs.join(lead, same).withColumn(names["at"], F.row_number().over(first))
    return found.where(F.col(names["at"]) == 1).drop(*names.values())


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = BUDGET) -> DataFrame:
    """One row of each component stays, with all its columns: that with the smallest id.

    Ties are settled as ``first_of_each`` says. An empty table stays empty.
    """
    marked, roots = _classes(docs, id_col, text_col, budget, PER_TRIE)
    return first_of_each(docs, marked, roots, id_col, text_col)


def op10(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
