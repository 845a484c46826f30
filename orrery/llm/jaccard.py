"""Near copies by exact similarity: texts whose sets of five-word shingles overlap by 80 % or more of their union.

The first candidates are those of ``simhash``: fingerprints of the shingle sets, linked by a walk over pairs of trie
nodes. At a similarity of 0.8 some ten of the 64 bits differ, so that the tries' budget of three leaves pairs out. The
rest comes from MinHash: ``BANDS`` keys per text, each of ``PER_BAND`` minima. A pair at a similarity of 0.8 shares no
key with a probability of (1 - 0.8**6)**50 = 3e-7, and one above it with less; nothing else decides by estimate, since
every candidate pair is checked on the whole sets of shingle hashes.

Only different texts enter. Texts of a key that the tries have not joined are first compared with one of them, another
for each key, so a group of near copies costs one pair per text and key and not its square. Texts that those links have
not joined and that still share a key meet over their rarest shingles, in an exact prefix and position filter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.llm.common import free_name, settled
from orrery.llm.components import components
from orrery.llm.simhash import first_of_each, links, majority_bits, shingles

WIDTH = 5
PERCENT = 80
SEED = 42
BANDS = 50
PER_BAND = 6
#: Shingles whose minima are taken at once.
HASHES_AT_ONCE = 1 << 9


def shingle_hashes(text: str | None) -> np.ndarray:
    """Sorted different hashes of the shingles of a text."""
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(s, SEED) for s in set(shingles(text, WIDTH))], np.uint64))


def _constants() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Factor and shift of each hash function, and the factors that mix a band's minima."""
    rng = np.random.default_rng(SEED)
    draw = lambda bits, kind, shape: rng.integers(0, 1 << bits, shape, kind)
    return draw(32, np.uint32, BANDS * PER_BAND) | np.uint32(1), draw(32, np.uint32, BANDS * PER_BAND), draw(63, np.uint64, (BANDS, PER_BAND)) | np.uint64(1)


def band_keys(hashes: np.ndarray, factors: np.ndarray, shifts: np.ndarray, mixers: np.ndarray) -> np.ndarray:
    """A key per band of a set that is not empty."""
    high = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(factors), np.iinfo(np.uint32).max, np.uint32)
    for k in range(0, len(high), HASHES_AT_ONCE):
        least = np.minimum(least, (factors[:, None] * high[None, k : k + HASHES_AT_ONCE] + shifts[:, None]).min(axis=1))
    keys = ((least.reshape(mixers.shape).astype(np.uint64) + np.uint64(1)) * mixers).sum(axis=1, dtype=np.uint64)
    keys ^= keys >> np.uint64(29)
    return (keys * mixers[:, 0]).view(np.int64)


def _signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_hash, n, fp, keys): the number of different shingles, their SimHash and the band keys of each row's whole text."""
    schema = T.StructType([docs.schema[id_col], T.StructField("text_hash", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("fp", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType()))])
    names = schema.names

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        constants = _constants()
        for b in batches:
            sizes, fps, keys = [], [], []
            for text in b.column(2).to_pylist():
                found = shingle_hashes(text)
                sizes.append(len(found))
                fps.append(majority_bits(found, np.array([len(found)])))
                keys.append(band_keys(found, *constants) if len(found) else [])
            fp = np.concatenate([np.zeros(0, np.uint64), *fps]).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sizes, pa.int32()), pa.array(fp), pa.array(keys, pa.list_(pa.int64()))], names)

    return docs.select(F.col(id_col), F.xxhash64(text_col), F.col(text_col).cast("string")).mapInArrow(of_batches, schema)


def _sets(texts: DataFrame) -> DataFrame:
    """(node, hashes) of (node, text)."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes = [shingle_hashes(x).view(np.int64) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(hashes, pa.list_(pa.int64()))], ["node", "hashes"])

    return texts.mapInArrow(of_batches, "node long, hashes array<long>")


def _sizes_fit(a: str, b: str) -> Column:
    """Whether sets of these sizes can be similar at all."""
    return F.least(a, b).cast("long") * 100 >= F.greatest(a, b).cast("long") * PERCENT


def _ordered(a: str, b: str) -> list[Column]:
    return [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]


def similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose sets overlap by ``PERCENT`` of their union or more."""
    side = lambda node, name: sets.select(F.col("node").alias(node), F.col("hashes").alias(name))
    both = pairs.join(side("u", "a"), "u").join(side("v", "b"), "v")
    # same / (a + b - same) >= p / 100
    same = F.size(F.array_intersect("a", "b")).cast("long")
    return both.where(same * (100 + PERCENT) >= (F.size("a") + F.size("b")).cast("long") * PERCENT).select("u", "v")


def _front(share: int, of: int) -> Column:
    """How many of n shingles come first if ``share / of`` of them, rounded up, must be shared."""
    return F.expr(f"n - (n * {share}L + {of - 1}) div {of} + 1")


def meeting(apart: DataFrame) -> DataFrame:
    """(u, v): pairs of different roots that can be similar, of (node, n, root, hashes); holds every pair that is.

    Shingles are put in order of their frequency among these nodes, rare ones first. Two sets that share enough
    share one among the first of both, and how many that are follows from their sizes: a crowd that has a passage
    in common, but not enough of it, does not meet, since what its texts have of their own comes first.
    """
    each = apart.select("node", "n", "root", F.explode("hashes").alias("h"))
    often = each.groupBy("h").agg(F.count("*").alias("often")).where("often > 1")
    of_node = Window.partitionBy("node")
    # Shingles of one node alone come before all others and meet nothing.
    place = F.col("n") - F.count("*").over(of_node) + F.row_number().over(of_node.orderBy("often", "h"))
    first = each.join(often, "h").withColumn("place", place).where(F.col("place") <= _front(PERCENT, 100))
    first = settled(first.select("h", "node", "n", "root", "place", (F.col("place") <= _front(2 * PERCENT, 100 + PERCENT)).alias("early")))
    # Where a shingle has one root, nothing meets; elsewhere only texts outside its commonest root look for others.
    by_root = first.groupBy("h", "root").agg(F.count("*").alias("nodes")).groupBy("h")
    first = first.join(by_root.agg(F.max_by("root", "nodes").alias("major"), F.count("*").alias("roots")).where("roots > 1"), "h")
    other = first.select("h", *(F.col(c).alias(f"{c}2") for c in ("node", "n", "root", "place", "early")))
    smaller = (F.col("n") < F.col("n2")) | ((F.col("n") == F.col("n2")) & (F.col("node") < F.col("node2")))
    meets = F.when(smaller, F.col("early")).otherwise(F.col("early2"))
    # Behind the first shared shingle no more can be shared than either set has left.
    shared = F.least(F.col("n") - F.col("place"), F.col("n2") - F.col("place2")) + 1
    enough = shared * (100 + PERCENT) >= (F.col("n") + F.col("n2")) * PERCENT
    found = first.where("root <> major").join(other, "h").where((F.col("root") != F.col("root2")) & meets & _sizes_fit("n", "n2") & enough)
    return found.select(*_ordered("node", "node2")).distinct()


def walked(marked: DataFrame) -> DataFrame:
    """(u, v): pairs of different texts that join all whose fingerprints the tries link, of (text_hash, n, fp, ...)."""
    lead = lambda name: F.min("node").alias(name)
    nodes = settled(marked.where("n > 0").select(F.col("text_hash").alias("node"), "fp").distinct())
    found = links(nodes.select("fp").distinct())
    found = found.join(nodes.groupBy(F.col("fp").alias("u")).agg(lead("at")), "u").join(nodes.groupBy(F.col("fp").alias("v")).agg(lead("to")), "v")
    alike = nodes.join(nodes.groupBy("fp").agg(lead("to")), "fp").where("node <> to")
    return found.select(*_ordered("at", "to")).unionByName(alike.select(*_ordered("node", "to"))).distinct()


def _not_joined(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (u, v) that do not lie in one component of ``roots`` (node, root)."""
    of = lambda node, name: roots.select(F.col("node").alias(node), F.col("root").alias(name))
    both = pairs.join(of("u", "a"), "u", "left").join(of("v", "b"), "v", "left")
    return both.where("a is null or b is null or a <> b").select("u", "v")


def _edges(marked: DataFrame, texts: DataFrame) -> DataFrame:
    """(u, v): pairs of similar nodes that join all similar nodes. ``texts``: (node, text), copies included."""
    rows = marked.where("n > 0").groupBy(F.col("text_hash").alias("node")).agg(F.first("n").alias("n"), F.first("keys").alias("keys"))
    rows = settled(rows.select("node", "n", F.explode("keys").alias("key")))
    crowds = rows.groupBy("key").agg(F.count("*").alias("crowd"), F.min(F.struct(F.xxhash64("key", "node").alias("at"), "node", "n")).alias("lead")).where("crowd > 1")
    rows = settled(rows.join(crowds, "key").select("key", "node", "n", F.col("lead.node").alias("lead"), F.col("lead.n").alias("lead_n")))
    near = settled(walked(marked))
    ends = [near.select(F.col(end).alias("node")) for end in ("u", "v")]
    named = rows.select("node").unionByName(ends[0]).unionByName(ends[1]).distinct()
    sets = settled(_sets(texts.join(named, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))))

    by_trie = settled(similar(near, sets))
    others = rows.where((F.col("node") != F.col("lead")) & _sizes_fit("n", "lead_n")).select(*_ordered("node", "lead")).distinct()
    tried = settled(_not_joined(others, settled(components(by_trie))))
    by_lead = settled(by_trie.unionByName(similar(tried, sets)))
    roots = components(by_lead).select("node", "root")
    rows = rows.select("key", "node", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rows = settled(rows)
    mixed = rows.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least < most").select("key")
    apart = settled(rows.join(mixed, "key").select("node", "n", "root").distinct())
    left = settled(meeting(apart.join(sets, "node")).join(tried, ["u", "v"], "left_anti"))
    return by_lead.unionByName(similar(left, sets))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near copies stays, with all its columns: that with the smallest id.

    A group is what links between similar texts reach. Words are cut at ASCII white space and A-Z lower-cased;
    a text shorter than five words is one shingle, and texts without a word, null included, are copies of each other.
    Ties are settled as in ``simhash.drop_near_duplicates``. An empty table stays empty.
    """
    marked = settled(_signed(docs, id_col, text_col))
    texts = docs.select(F.xxhash64(text_col).alias("node"), F.col(text_col).cast("string").alias("text"))
    roots = settled(components(_edges(marked, texts)))
    wordless = F.lit(0).cast("long")
    key = free_name(marked, "node")
    marked = marked.select(F.col(id_col), "text_hash", F.when(F.col("n") == 0, wordless).otherwise(F.col("text_hash")).alias(key))
    names = marked.select(key).distinct().join(roots.withColumnRenamed("node", key), key, "left").withColumn("root", F.coalesce("root", key))
    return first_of_each(docs, marked, settled(names), id_col, text_col, key)
