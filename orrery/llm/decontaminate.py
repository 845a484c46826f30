"""Benchmark decontamination with spaced seeds.

A seed is a mask over a few consecutive tokens; its hash covers the marked positions only, so a substituted
token under an ignored position changes nothing. Hashes of all test items and of all documents are joined;
every hit fixes an alignment of document and item, and the tokens around it are compared one by one. An
overlap is reported if a window of ``WINDOW`` tokens (the whole item, if shorter) agrees in ``SHARE`` of them.

Only document hashes that pass a Bloom filter of the test hashes leave their task, with the tokens around
them. The filter has a fixed size; a larger benchmark lets more hashes through, and the join still decides.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.llm.common import free_name, settled, table

#: Seeds of weight 6; the first is contiguous, the others ignore up to half of what they span. Whatever three of
#: 15 tokens are substituted, one of them fits around these.
MASKS = ("111111", "11011011", "1101001011", "11100100101", "1010100111")
SPAN = max(map(len, MASKS))
WINDOW = 15
SHARE = 0.8
#: Items with fewer tokens are no evidence and are never reported.
MIN_TOKENS = 5
FILTER_BITS = 25
_LONGS = T.ArrayType(T.LongType())
_WORD = re.compile(r"[^\W_]+")
_ODD = [int(xxhash.xxh64_intdigest(f"seed {i}")) | 1 for i in range(max(SPAN, WINDOW) + 2)]


class _Hashes(dict):
    """Token to 64-bit hash; kept for the tokens met so far, up to a bound."""

    def __missing__(self, token: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[token] = h = xxhash.xxh64_intdigest(token)
        return h


def tokens_of(text: str | None, known: dict) -> np.ndarray:
    """Hashes of the lower-cased runs of letters and digits."""
    found = _WORD.findall((text or "").lower())
    return np.fromiter(map(known.__getitem__, found), np.uint64, len(found))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def seed_hashes(tokens: np.ndarray, mask: str, number: int) -> np.ndarray:
    """Hash of each position at which the mask fits."""
    n = len(tokens) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, _ODD[number % len(_ODD)] * (number + 1) & (2**64 - 1), np.uint64)
    for i, c in enumerate(mask):
        if c == "1":
            h += tokens[i : i + n] * np.uint64(_ODD[i])
    return _mixed(h)


def _whole_masks(n: int) -> list[str]:
    """Masks over all ``n`` tokens of a short item, one for each choice of substituted tokens that ``SHARE`` allows."""
    ignored = n - math.ceil(SHARE * n - 1e-9)
    return ["".join("0" if i in gone else "1" for i in range(n)) for gone in combinations(range(n), ignored)]


def _all_seeds(tokens: np.ndarray, short: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) for every mask, and those over whole items for the lengths in ``short``."""
    masks = [*enumerate(MASKS), *((1000 * n + j, m) for n in short for j, m in enumerate(_whole_masks(n)))]
    found = [seed_hashes(tokens, m, k) for k, m in masks]
    return np.concatenate([np.arange(len(h), dtype=np.int64) for h in found]), np.concatenate(found)


def _test_items(tests: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, copies, tokens, at, keys): items of different tokens, under the smallest id of their copies."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for b in batches:
            toks = [tokens_of(t, known).view(np.int64) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(toks, pa.list_(pa.int64()))], ["item", "tokens"])

    schema = tests.select(F.col(id_col).alias("item")).schema.add("tokens", _LONGS)
    read = tests.select(F.col(id_col).alias("item"), F.col(text_col).cast("string")).mapInArrow(of_batches, schema)
    return read.where(F.size("tokens") >= MIN_TOKENS).groupBy("tokens").agg(F.min("item").alias("item"), F.count("*").alias("copies"))


def _keys(items: DataFrame) -> DataFrame:
    """(item, at, key): seeds of each item; an item shorter than a window also has those over its whole length."""
    schema = items.select("item").schema.add("n", "integer").add("at", _LONGS).add("keys", _LONGS)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, keys, size = [], [], []
            for t in b.column(1):
                toks = t.values.to_numpy(zero_copy_only=False).view(np.uint64)
                short = len(toks) if len(toks) < WINDOW else 0
                a, k = _all_seeds(toks, (short,) if short else ())
                at.append(a)
                keys.append(k.view(np.int64))
                size.append(short)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int32()), pa.array(at, pa.list_(pa.int64())), pa.array(keys, pa.list_(pa.int64()))], ["item", "n", "at", "keys"])

    found = items.select("item", "tokens").mapInArrow(of_batches, schema)
    return found.select("item", "n", F.explode(F.arrays_zip("at", "keys")).alias("s")).select("item", "n", "s.at", F.col("s.keys").alias("key"))


def _filter(keys: DataFrame) -> np.ndarray:
    """A Bloom filter of two bits per key; its words that are not empty come to the driver, 2**FILTER_BITS bits at most."""
    bit = F.explode(F.array(F.col("key").bitwiseAND((1 << FILTER_BITS) - 1), F.shiftrightunsigned("key", 32).bitwiseAND((1 << FILTER_BITS) - 1)))
    words = keys.select(bit.alias("b")).groupBy(F.shiftright("b", 5).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 31 as int))")).alias("m"))
    out = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    got = words.toPandas()
    out[got["w"].to_numpy(np.int64)] = got["m"].to_numpy(np.int64).astype(np.uint32)
    return out


def _passes(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Positions of ``keys`` whose two bits are set."""
    low = np.uint64((1 << FILTER_BITS) - 1)
    has = lambda b: (words[b >> np.uint64(5)] >> (b & np.uint64(31)).astype(np.uint32)) & np.uint32(1)
    first = np.flatnonzero(has(keys & low))
    return first[has((keys[first] >> np.uint64(32)) & low) > 0]


def _stretches(docs: DataFrame, id_col: str, text_col: str, words: np.ndarray, short: tuple[int, ...]) -> DataFrame:
    """(doc, text_hash, start, tokens, at, keys): token stretches around the seeds that pass the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(words)
    schema = docs.select(F.col(id_col).alias("doc")).schema.add("text_hash", "long").add("start", "long").add("tokens", _LONGS).add("at", _LONGS).add("keys", _LONGS)
    reach = WINDOW + SPAN

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        bloom = shared.value
        for b in batches:
            rows, starts, toks, ats, keys = [], [], [], [], []
            for row, text in enumerate(b.column(2).to_pylist()):
                t = tokens_of(text, known)
                at, key = _all_seeds(t, short)
                hit = _passes(bloom, key)
                if not len(hit):
                    continue
                hit = hit[np.argsort(at[hit], kind="stable")]
                at, key = at[hit], key[hit]
                for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at) > 2 * reach) + 1):
                    lo, hi = max(0, int(at[part[0]]) - reach), int(at[part[-1]]) + SPAN + reach
                    rows.append(row)
                    starts.append(lo)
                    toks.append(t[lo:hi].view(np.int64))
                    ats.append(at[part])
                    keys.append(key[part].view(np.int64))
            where = pa.array(rows, pa.int64())
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (toks, ats, keys)]
            yield pa.RecordBatch.from_arrays([b.column(0).take(where), b.column(1).take(where), pa.array(starts, pa.int64()), *lists], schema.names)

    return docs.select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).cast("string")).mapInArrow(of_batches, schema)


def _best_window(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int]:
    """(equal tokens, size, start in ``doc``) of the best window when doc[i] lies over item[i - shift]."""
    lo, hi = max(0, shift), min(len(doc), shift + len(item))
    size = min(WINDOW, len(item))
    if hi - lo < size:
        return 0, size, lo
    upto = np.concatenate([[0], np.cumsum(doc[lo:hi] == item[lo - shift : hi - shift])])
    equal = upto[size:] - upto[:-size]
    at = int(np.argmax(equal))
    return int(equal[at]), size, lo + at


def _found(docs: DataFrame, tests: DataFrame, id_col: str, text_col: str, item_col: str, test_text_col: str) -> DataFrame:
    """(doc, text_hash, item, equal, compared, at): the best verified window of each text and item."""
    items = settled(_test_items(tests, item_col, test_text_col))
    keys = settled(_keys(items))
    short = tuple(sorted(r[0] for r in keys.where("n > 0").select("n").distinct().collect()))  # lengths below WINDOW
    stretches = settled(_stretches(docs, id_col, text_col, _filter(keys), short))
    seeds = stretches.select("doc", "text_hash", "start", F.explode(F.arrays_zip("at", "keys")).alias("s"))
    seeds = seeds.select("doc", "text_hash", "start", F.col("s.at").alias("d"), F.col("s.keys").alias("key"))
    hits = seeds.join(keys, "key").select(F.col("doc").alias("doc2"), F.col("text_hash").alias("hash2"), F.col("start").alias("start2"), "item", (F.col("d") - F.col("at") - F.col("start")).alias("shift")).distinct()
    same = F.col("doc").eqNullSafe(F.col("doc2")) & (F.col("text_hash") == F.col("hash2")) & (F.col("start") == F.col("start2"))
    near = hits.join(stretches.select("doc", "text_hash", "start", "tokens").distinct(), same).join(items.select(F.col("item").alias("item2"), F.col("tokens").alias("item_tokens")), F.col("item").eqNullSafe(F.col("item2")))
    near = near.select("doc", "text_hash", "start", "item", "shift", "tokens", "item_tokens")
    schema = near.select("doc", "text_hash", "item").schema.add("equal", "integer").add("compared", "integer").add("at", "long")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shift, start = b.column("shift").to_pylist(), b.column("start").to_pylist()
            array = lambda c: [x.values.to_numpy(zero_copy_only=False) for x in b.column(c)]
            best = [_best_window(d, i, s) for d, i, s in zip(array("tokens"), array("item_tokens"), shift, strict=True)]
            ok = np.array([e >= SHARE * n for e, n, _ in best], bool)
            where = pa.array(np.flatnonzero(ok))
            cols = [pa.array([x[k] for x in best], t).take(where) for k, t in ((0, pa.int32()), (1, pa.int32()))]
            at = pa.array([s + x[2] for s, x in zip(start, best, strict=True)], pa.int64()).take(where)
            yield pa.RecordBatch.from_arrays([b.column("doc").take(where), b.column("text_hash").take(where), b.column("item").take(where), *cols, at], schema.names)

    verified = near.mapInArrow(of_batches, schema)
    best = F.max(F.struct("equal", (-F.col("at")).alias("early"), "compared")).alias("b")
    return verified.groupBy("doc", "text_hash", "item").agg(best).select("doc", "text_hash", "item", "b.equal", "b.compared", (-F.col("b.early")).alias("at"))


def overlaps(docs: DataFrame, tests: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", test_text_col: str = "text") -> DataFrame:
    """(id, item, equal, compared, at): documents that contain a passage of a test item, and where (token number).

    Items with the same tokens are one, under their smallest id. Null and empty texts contain nothing. Rows
    with one id and text are reported once, those with one id and different texts once per text. Null ids are
    reported as null. Empty tables give an empty result; other columns are left out.
    """
    found = _found(docs, tests, id_col, text_col, item_col, test_text_col)
    return found.select(F.col("doc").alias(id_col), F.col("item").alias(item_col), "equal", "compared", "at")


def drop_contaminated(docs: DataFrame, tests: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", test_text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that contain a passage of a test item."""
    d, h = free_name(docs, "doc_"), free_name(docs, "hash_")
    found = _found(docs, tests, id_col, text_col, item_col, test_text_col).select(F.col("doc").alias(d), F.col("text_hash").alias(h)).distinct()
    return docs.join(found, F.col(id_col).eqNullSafe(F.col(d)) & (F.xxhash64(text_col) == F.col(h)), "left_anti")


def op1(spark, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
