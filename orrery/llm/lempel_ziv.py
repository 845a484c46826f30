"""Removal of passages that stand in an earlier document, by relative Lempel-Ziv parsing.

A document is read as a sequence of factors, each a copy of a stretch of a reference; a factor of ``WINDOW``
words or more is a duplicate span. The reference are the documents themselves, each for those after it, in
blocks that a task can index. Reading every document against every block would be quadratic, so documents go
only to blocks with which they can share a window:

1. An anchor is the ``ANCHOR``-word group with the smallest hash in a window; equal windows have equal anchors.
   Spark counts anchors; those of one document alone go, and each other one names the first document with it.
2. Around its anchors, a document is cut into pieces. The first document of an anchor puts its piece into the
   reference block of its id; every other one sends its piece there to be parsed.
3. A task indexes a block's windows and parses piece after piece: it looks up windows until one is found, extends
   the match as far as the words agree, and goes on at the factor's boundary, with the first window that is
   not wholly inside the factor.
4. A window that no block has may still be a copy from a document that is not the first one of its anchor.
   Such windows at the boundaries are counted by their 128-bit hashes, which finds their first document.

Steps 3 and 4 find every window that an earlier document has, and no other. Equal texts are parsed once. Blocks
to which many pieces go are dealt to several tasks. Filters of fixed size keep rows that cannot matter from
being shuffled; a larger input lets more of them through, and the joins decide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.llm.common import settled, table

WINDOW = 13
ANCHOR = 7
#: Words of a reference block, and of the pieces that one task parses against it.
BLOCK_WORDS = 200_000
TASK_WORDS = 500_000
#: Words after which a new piece begins, bytes hashed at once, rows of a result batch.
PIECE_WORDS = 512
BYTES_AT_ONCE = 1 << 21
ROWS_AT_ONCE = 1 << 14
FILTER_BITS = 25
_LATEST = 2**63 - 1
_SPANS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
#: Odd, so that every power has an inverse modulo 2**64.
_BASE = 0x9FB21C651E98DF25
_INVERSE = pow(_BASE, -1, 1 << 64)
_IN_WORD = np.array([b not in b" \t\n\x0b\x0c\r" for b in range(256)])
_rng = np.random.default_rng(13)
_FIRST, _SECOND = (_rng.integers(0, 1 << 63, WINDOW, np.uint64) << np.uint64(1) | np.uint64(1) for _ in range(2))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2**64."""
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(base)
    return np.cumprod(out, dtype=np.uint64)


def hashed_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word of all texts, number of words of each text).

    A word's hash is the value of its bytes as a polynomial, taken from running sums over whole stretches of
    text, mixed with its length. Stretches have about ``BYTES_AT_ONCE`` bytes, whatever the texts' length.
    """
    data = b" ".join([(t or "").encode() for t in texts]) + b" "
    hashes, begins, at = [], [], 0
    while at < len(data):
        end = len(data) if at + BYTES_AT_ONCE >= len(data) else data.rfind(b" ", at, at + BYTES_AT_ONCE) + 1
        if end <= at:  # a word longer than a stretch
            end = data.index(b" ", at) + 1
        raw = np.frombuffer(data, np.uint8, end - at, at)
        inside = _IN_WORD[raw]
        edges = np.flatnonzero(np.diff(inside, prepend=False))
        first, last = edges[::2], edges[1::2]
        n = len(raw)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((raw + np.uint64(1)) * _powers(_BASE, n), out=sums[1:])
        value = (sums[last] - sums[first]) * _powers(_INVERSE, n)[first]
        hashes.append(_mixed(value + (last - first).astype(np.uint64) * np.uint64(_BASE)))
        begins.append(first + at)
        at = end
    ends = np.cumsum([len((t or "").encode()) + 1 for t in texts])
    begins = np.concatenate(begins)
    return np.concatenate(hashes), np.diff(np.searchsorted(begins, ends), prepend=0)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(31))


def runs(words: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Hash of every run of ``len(factors)`` words."""
    n = len(words) - len(factors) + 1
    if n < 1:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k, f in enumerate(factors):
        out += words[k : k + n] * f
    return _mixed(out)


def anchors(words: np.ndarray, window: int, width: int, sizes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the groups of ``width`` words with the smallest hash of a window, all of them if several.

    ``sizes`` are the numbers of words of several texts that follow each other; no window is in two of them.
    """
    sizes = np.array([len(words)]) if sizes is None else sizes
    hashes = runs(words, _FIRST[:width])
    span = window - width + 1
    n = len(hashes) - span + 1
    if n < 1:
        return np.empty(0, np.int64), hashes[:0]
    least = hashes[:n]
    for k in range(1, span):
        least = np.minimum(least, hashes[k : k + n])
    inside = np.arange(n) + window <= np.repeat(np.cumsum(sizes), sizes)[:n]
    chosen = np.zeros(len(hashes), bool)
    for k in range(span):
        chosen[k : k + n] |= (hashes[k : k + n] == least) & inside
    at = np.flatnonzero(chosen)
    return at, hashes[at]


def _batches(batches: Iterator[pa.RecordBatch], text: str = "text", leading=None) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with a bounded number of text bytes, of the rows that ``leading`` lets through."""
    for b in batches:
        b = b if leading is None else b.filter(pa.array(leading(b)))
        sizes = np.cumsum([len(t or "") for t in b.column(text).to_pylist()])
        at = 0
        while at < b.num_rows:
            n = max(1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BYTES_AT_ONCE, "right")) - at)
            yield b.slice(at, n)
            at += n


def bloom(keys: DataFrame, column: str) -> np.ndarray:
    """Two bits for each 64-bit key, in a table of 2**FILTER_BITS bits whatever the input; it comes to the driver in packed parts."""
    low, per_part = (1 << FILTER_BITS) - 1, 1 << 14

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for b in batches:
            word, mask = b.column("word").to_numpy(), b.column("mask").to_numpy().astype(np.uint32)
            for part in np.unique(word // per_part).tolist():
                own = word // per_part == part
                parts.setdefault(part, np.zeros(per_part, np.uint32))[word[own] % per_part] = mask[own]
        yield pa.RecordBatch.from_arrays([pa.array(parts.keys(), pa.int64()), pa.array([x.tobytes() for x in parts.values()], pa.binary())], ["part", "bits"])

    each = F.explode(F.array(F.col(column).bitwiseAND(low), F.shiftrightunsigned(column, 32).bitwiseAND(low)))
    words = keys.select(each.alias("b")).groupBy(F.shiftright("b", 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 31 as int))")).alias("mask"))
    out = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    # A part is one task's: words are exchanged once more, sixteen bytes each.
    for part, bits in words.repartition(F.floor(F.col("word") / per_part)).mapInArrow(packed, "part long, bits binary").collect():
        out[part * per_part : (part + 1) * per_part] |= np.frombuffer(bits, np.uint32)
    return out


def in_bloom(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    low = np.uint64((1 << FILTER_BITS) - 1)
    has = lambda b: (bits[b >> np.uint64(5)] >> (b & np.uint64(31)).astype(np.uint32)) & np.uint32(1)
    return (has(keys & low) & has((keys >> np.uint64(32)) & low)) > 0


def _signed(rows: DataFrame) -> DataFrame:
    """(at, id, digest, text_key, row_key, n_words, kept_sha256) of keyed rows: the last as if every word stayed."""
    schema = T.StructType([*rows.schema.fields[:5], *T.StructType.fromDDL("n_words long, kept_sha256 string").fields])

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _batches(batches):
            words = [words_of(t) for t in b.column("text").to_pylist()]
            shas = [hashlib.sha256(b" ".join(w)).hexdigest() for w in words]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array([len(w) for w in words], pa.int64()), pa.array(shas, pa.string())], schema.names)

    return rows.mapInArrow(of_batches, schema)


class Leads:
    """Lets the first of equal texts through, and a few others by mistake, which costs time and changes nothing.

    ``copied`` are the texts that several rows have, ``first`` the first rows of those texts that it names, so
    a text that it names by mistake is let through as well. Neither text nor row is shuffled for this.
    """

    def __init__(self, copied, first):
        self.copied, self.first = copied, first

    def __call__(self, b: pa.RecordBatch) -> np.ndarray:
        text, row = (b.column(c).to_numpy().view(np.uint64) for c in ("text_key", "row_key"))
        return ~in_bloom(self.copied.value, text) | in_bloom(self.first.value, row)


def _leads(signed: DataFrame, copies: DataFrame) -> Leads:
    """``signed``: (digest, at, text_key, row_key) of all rows; ``copies``: (digest, least) of texts of several rows."""
    context = signed.sparkSession.sparkContext
    copied = context.broadcast(bloom(copies.select(F.xxhash64("digest").alias("key")), "key"))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(in_bloom(copied.value, b.column("text_key").to_numpy().view(np.uint64))))

    rows = signed.select("digest", "at", "text_key", "row_key")
    first = rows.mapInArrow(named, rows.schema).join(copies, "digest", "left").where("least IS NULL OR at = least")
    return Leads(copied, context.broadcast(bloom(first, "row_key")))


def _anchored(rows: DataFrame, leading, window: int, width: int) -> DataFrame:
    """(anchor, least, most): the smallest and largest ``at`` of the rows that have an anchor; folded in the tasks too."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _batches(batches, leading=leading):
            hashes, sizes = hashed_words(b.column("text").to_pylist())
            where, keys = anchors(hashes, window, width, sizes)
            at = np.repeat(b.column("at").to_numpy(), sizes)[where]
            order = np.lexsort((at, keys))
            keys, at = keys[order], at[order]
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
            last = np.append(first[1:], len(keys))[: len(first)] - 1
            yield pa.RecordBatch.from_arrays([pa.array(keys[first].view(np.int64)), pa.array(at[first]), pa.array(at[last])], ["anchor", "least", "most"])

    each = rows.mapInArrow(of_batches, "anchor long, least long, most long")
    return each.groupBy("anchor").agg(F.min("least").alias("least"), F.max("most").alias("most"))


def _pieces(rows: DataFrame, leading, shared, window: int, width: int) -> DataFrame:
    """(text, at, begin, words, n, places): stretches of a row's word hashes around anchors that pass the filter.

    ``places`` has (place of the anchor in the piece, anchor); all windows with one of them lie in the piece.
    """
    before, behind = window - width, window

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _batches(batches, leading=leading):
            digests, ats = b.column("digest").to_pylist(), b.column("at").to_pylist()
            hashes, sizes = hashed_words(b.column("text").to_pylist())
            places, keys = anchors(hashes, window, width, sizes)
            passed = in_bloom(shared.value, keys)
            places, keys = places[passed], keys[passed].view(np.int64)
            owner, ends = np.repeat(np.arange(len(sizes)), sizes)[places], np.cumsum(sizes)
            # A new piece in each text, where the stretches around two anchors do not touch, and after PIECE_WORDS words.
            apart = np.append(True, (places[1:] - before > places[:-1] + behind) | (owner[1:] != owner[:-1]))[: len(places)]
            since = places - places[np.maximum.accumulate(np.where(apart, np.arange(len(places)), 0))] if len(places) else places
            new = np.flatnonzero(apart[1:] | (np.diff(since // PIECE_WORDS) != 0)) + 1 if len(places) else places
            out: list[tuple] = []
            for part in np.split(np.arange(len(places)), new) if len(places) else ():
                own = int(owner[part[0]])
                base, end = int(ends[own] - sizes[own]), int(ends[own])
                begin, end = max(base, int(places[part[0]]) - before), min(end, int(places[part[-1]]) + behind)
                named = [{"place": p - begin, "anchor": k} for p, k in zip(places[part].tolist(), keys[part].tolist(), strict=True)]
                out.append((digests[own], ats[own], begin - base, hashes[begin:end].tobytes(), end - begin, named))
            cols = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.binary(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.list_(pa.struct([("place", pa.int32()), ("anchor", pa.int64())]))]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["digest", "at", "begin", "words", "n", "places"])

    return rows.mapInArrow(of_batches, "digest binary, at long, begin int, words binary, n int, places array<struct<place:int, anchor:long>>")


def _routed(pieces: DataFrame, firsts: DataFrame, blocks: int, window: int, width: int) -> DataFrame:
    """(block, query, digest, at, begin, words): for each block of a piece, the part around that block's anchors."""
    before, behind = window - width, window
    keys = ["digest", "at", "begin"]
    block = F.pmod(F.xxhash64("first"), F.lit(blocks)).alias("block")
    met = pieces.select(*keys, F.inline("places")).join(firsts.select("anchor", F.col("least").alias("first")), "anchor")
    met = met.select(*keys, block, (F.col("at") > F.col("first")).alias("query"), "place").groupBy(*keys)
    routes = met.agg(F.collect_list(F.struct("block", "query", "place")).alias("routes"))
    schema = "block long, query boolean, digest binary, at long, begin int, words binary"

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = schema.replace(",", "").split()[::2]
        kinds = [pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.int32(), pa.binary()]
        for b in batches:
            out = []
            for digest, at, begin, words, n, found in zip(*(b.column(c).to_pylist() for c in (*keys, "words", "n", "routes")), strict=True):
                ways: dict[tuple, list[int]] = {}
                for r in found:
                    ways.setdefault((r["block"], r["query"]), []).append(r["place"])
                for (to, query), places in ways.items():
                    places.sort()
                    start = end = None
                    for p in places:
                        if end is not None and p - before > end:
                            out.append((to, query, digest, at, begin + start, words[8 * start : 8 * end]))
                            start = None
                        start = max(0, p - before) if start is None else start
                        end = min(n, p + behind)
                    out.append((to, query, digest, at, begin + start, words[8 * start : 8 * end]))
            for k in range(0, len(out), ROWS_AT_ONCE):
                cols = zip(*out[k : k + ROWS_AT_ONCE], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)

    return pieces.drop("places").join(routes, keys).mapInArrow(of_batches, schema)


class Block:
    """The windows of reference pieces, each at its place in the piece of the smallest ``at`` that has it."""

    def __init__(self, pieces: list[tuple[int, np.ndarray]], window: int):
        self.window = window
        pieces = sorted((p for p in pieces if len(p[1]) >= window), key=lambda p: p[0])
        sizes = np.array([len(w) for _, w in pieces], np.int64)
        self.words = np.concatenate([w for _, w in pieces]) if pieces else np.empty(0, np.uint64)
        self.ends = np.repeat(np.cumsum(sizes), sizes)
        self.ats = np.repeat(np.array([a for a, _ in pieces], np.int64), sizes)
        hashes = runs(self.words, _FIRST[:window])
        starts = np.flatnonzero(np.arange(len(hashes)) + window <= self.ends[: len(hashes)])
        # np.unique names the first of equal values, and pieces are in the order of `at`.
        self.keys, first = np.unique(hashes[starts], return_index=True)
        self.starts = starts[first]

    def factors(self, at: int, words: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray]:
        """(begin, end) of the factors of ``window`` words or more that begin before ``at`` in the reference, and the
        windows that are in none of them."""
        hashes = runs(words, _FIRST[: self.window])
        if not len(hashes):
            return [], np.empty(0, np.int64)
        where = np.minimum(np.searchsorted(self.keys, hashes), max(0, len(self.keys) - 1))
        found = np.zeros(len(hashes), bool) if not len(self.keys) else self.keys[where] == hashes
        found[found] = self.ats[self.starts[where[found]]] < at
        hits = np.flatnonzero(found)
        spans, k = [], 0
        while k < len(hits):
            begin = int(hits[k])
            start = int(self.starts[where[begin]])
            n = self._agree(words, begin, start)
            if n < self.window:  # equal hash, other words
                found[begin] = False
                k += 1
                continue
            spans.append((begin, begin + n))
            found[begin : begin + n - self.window + 1] = True
            # On at the boundary: the first window with a word behind the factor.
            k = int(np.searchsorted(hits, begin + n - self.window + 1))
        return spans, np.flatnonzero(~found)

    def _agree(self, words: np.ndarray, begin: int, start: int) -> int:
        """How many words from here on are equal in both."""
        most = min(len(words) - begin, int(self.ends[start]) - start)
        done, size = 0, 4 * self.window
        while done < most:
            n = min(size, most - done)
            differ = np.flatnonzero(words[begin + done : begin + done + n] != self.words[start + done : start + done + n])
            if len(differ):
                return done + int(differ[0])
            done += n
            size *= 2
        return most


def _parsed(routed: DataFrame, window: int, task_words: int) -> DataFrame:
    """(digest, at, spans, open): factors of each piece, as (begin, end), and the windows at no factor, as (h1, h2, begin)."""
    load = routed.groupBy("block").agg(F.sum(F.when(F.col("query"), F.octet_length("words") / 8).otherwise(0)).alias("load"))
    tasks = load.where("load > 0").select("block", F.ceil(F.col("load") / task_words).cast("int").alias("tasks"))
    own = F.pmod(F.xxhash64("digest", "at", "begin"), F.col("tasks")).cast("int")
    dealt = routed.join(tasks, "block").withColumn("task", F.explode(F.when(F.col("query"), F.array(own)).otherwise(F.sequence(F.lit(0), F.col("tasks") - 1))))
    names = ["block", "task", "query", "digest", "at", "begin", "words"]
    dealt = dealt.select(*names).repartition("block", "task").sortWithinPartitions("block", "task", "query")
    schema = "digest binary, at long, spans array<struct<begin:int, end:int>>, open array<struct<h1:long, h2:long, begin:int>>"

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_type = pa.list_(pa.struct([("h1", pa.int64()), ("h2", pa.int64()), ("begin", pa.int32())]))
        name, reference, index = None, [], None
        out: list[tuple] = []

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) or [()] * 4
            made = [pa.array(c, t) for c, t in zip(cols, [pa.binary(), pa.int64(), _SPANS, open_type], strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(made, ["digest", "at", "spans", "open"])

        for b in batches:
            for block, task, query, digest, at, begin, data in zip(*(b.column(c).to_pylist() for c in names), strict=True):
                if name != (block, task):
                    name, reference, index = (block, task), [], None
                words = np.frombuffer(data, np.uint64)
                if not query:
                    reference.append((at, words))
                    continue
                if index is None:
                    index = Block(reference, window)
                spans, rest = index.factors(at, words)
                h1, h2 = (runs(words, f[:window])[rest].view(np.int64).tolist() for f in (_FIRST, _SECOND))
                out.append((digest, at, [{"begin": begin + x, "end": begin + y} for x, y in spans], [{"h1": p, "h2": q, "begin": begin + int(k)} for p, q, k in zip(h1, h2, rest, strict=True)]))
                if len(out) >= 256:
                    yield batch()
        yield batch()

    return dealt.mapInArrow(of_batches, schema)


def _left_over(parsed: DataFrame, window: int) -> DataFrame:
    """(digest, at, begin, end): windows that no block has but a document before does."""
    rows = parsed.select("digest", "at", F.inline("open"))
    first = rows.groupBy("h1", "h2").agg(F.min("at").alias("least"), F.max("at").alias("most")).where("least < most").select("h1", "h2", "least")
    return rows.join(first, ["h1", "h2"]).where("at > least").select("digest", "at", "begin", (F.col("begin") + window).alias("end"))


def _cut(rows: DataFrame) -> DataFrame:
    """(digest, at, n_removed, kept_sha256, kept, spans) of (digest, at, text, spans); spans merged, the words that stay joined."""
    schema = "digest binary, at long, n_removed long, kept_sha256 string, kept string, spans array<struct<begin:int, end:int>>"

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _batches(batches):
            out = []
            for digest, at, text, spans in zip(*(b.column(c).to_pylist() for c in ("digest", "at", "text", "spans")), strict=True):
                words = words_of(text)
                merged: list[list[int]] = []
                for s in sorted((s["begin"], s["end"]) for s in spans):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append(list(s))
                edges = [0, *(x for s in merged for x in s), len(words)]
                kept = b" ".join([w for x, y in zip(edges[::2], edges[1::2], strict=True) for w in words[x:y]])
                out.append((digest, at, sum(y - x for x, y in merged), hashlib.sha256(kept).hexdigest(), kept.decode(), [{"begin": x, "end": y} for x, y in merged]))
            cols = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.string(), _SPANS]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["digest", "at", "n_removed", "kept_sha256", "kept", "spans"])

    return rows.mapInArrow(of_batches, schema)


def _passing(rows: DataFrame, bits) -> DataFrame:
    """The rows of (digest, at, row_key, text) whose key may be in the filter."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(in_bloom(bits.value, b.column("row_key").to_numpy().view(np.uint64))))

    return rows.mapInArrow(of_batches, rows.schema).drop("row_key")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(at, id, digest, text_key, row_key, text); ``at`` orders the rows, null ids last, and the keys are for filters."""
    text = F.col(text_col).cast("string")
    at = F.coalesce(F.col(id_col).cast("long"), F.lit(_LATEST))
    rows = docs.select(at.alias("at"), F.col(id_col).alias("id"), F.unhex(F.md5(F.coalesce(text, F.lit("")))).alias("digest"), text.alias("text"))
    return rows.select("at", "id", "digest", F.xxhash64("digest").alias("text_key"), F.xxhash64("digest", "at").alias("row_key"), "text")


def _removals(keyed: DataFrame, signed: DataFrame, window: int, width: int, block_words: int, task_words: int) -> tuple[DataFrame, DataFrame]:
    """(digest, least): the first place of texts that several rows have; and what ``_cut`` says of the parsed rows."""
    context = keyed.sparkSession.sparkContext
    copies = signed.groupBy("digest").agg(F.min("at").alias("least"), F.max("at").alias("most")).where("least < most")
    copies = settled(copies.select("digest", "least"))
    # Of equal texts the first is parsed: the others lose everything. Rows alike in id and text are parsed alike.
    leading = _leads(signed, copies)
    rows = keyed.select("digest", "at", "text_key", "row_key", "text")
    firsts = settled(_anchored(rows, leading, window, width).where("least < most").select("anchor", "least"))
    pieces = settled(_pieces(rows, leading, context.broadcast(bloom(firsts, "anchor")), window, width).dropDuplicates(["digest", "at", "begin"]))
    blocks = max(1, -(-(pieces.agg(F.sum("n")).first()[0] or 0) // block_words))
    routed = settled(_routed(pieces, firsts, blocks, window, width))
    found = settled(_parsed(routed, window, task_words))
    spans = found.select("digest", "at", F.inline("spans")).unionByName(_left_over(found, window))
    spans = settled(spans.groupBy("digest", "at").agg(F.collect_set(F.struct("begin", "end")).alias("spans")))
    bits = context.broadcast(bloom(spans.select(F.xxhash64("digest", "at").alias("key")), "key"))
    texts = _passing(keyed.select("digest", "at", "row_key", "text"), bits)
    return copies, _cut(texts.join(spans, ["digest", "at"]).dropDuplicates(["digest", "at"]))


def parsed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, width: int = ANCHOR, block_words: int = BLOCK_WORDS, task_words: int = TASK_WORDS) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, kept, spans) of every row.

    A word goes if it lies in ``window`` consecutive words of its row that also begin in a row with a smaller id.
    ``spans`` are the word ranges (begin, end) that go and ``kept`` the words that stay, joined by one space; both are
    null where nothing goes. Rows with equal ids are not earlier than each other, null ids come after all others.
    Null, blank and short texts lose nothing. Repeated rows stay. An empty table gives an empty result; other
    columns are left out. Ids are integers; only words decide, so white space between them may differ.
    """
    keyed = _keyed(docs, id_col, text_col)
    signed = settled(_signed(keyed))
    copies, cut = _removals(keyed, signed, window, width, block_words, task_words)
    cut = cut.withColumnsRenamed({"kept_sha256": "cut_sha256"})
    found = signed.join(copies, "digest", "left").join(cut, ["digest", "at"], "left")
    copy = (F.col("at") > F.col("least")) & (F.col("n_words") >= window)
    none = hashlib.sha256(b"").hexdigest()
    whole = F.array(F.struct(F.lit(0).alias("begin"), F.col("n_words").cast("int").alias("end")))
    return found.select(
        F.col("id").alias(id_col), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, F.lit(none)).otherwise(F.coalesce("cut_sha256", "kept_sha256")).alias("kept_sha256"),
        F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept"),
        F.when(copy, whole).otherwise(F.col("spans")).alias("spans"),
    )


def op12(spark, sf_dir: str) -> DataFrame:
    return parsed(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


OP12_SQL = rf"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ 	-
]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, i, list_slice(w, i, i + {WINDOW - 1}) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d)),
f AS (SELECT g, min(doc_id) AS least FROM g GROUP BY g),
s AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS k FROM g JOIN f USING (g) WHERE doc_id > least),
w AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d),
c AS (SELECT w.doc_id, count(s.k) AS n_removed, string_agg(w.word, ' ' ORDER BY w.k) FILTER (s.k IS NULL) AS kept FROM w LEFT JOIN s ON w.doc_id = s.doc_id AND w.k = s.k GROUP BY w.doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN c ON d.doc_id = c.doc_id
"""
