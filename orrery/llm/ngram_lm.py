"""Stupid-backoff scores of documents under the bigram model of all other documents.

Counts and scores move as tables of n-grams. Documents form blocks; a block's n-grams are exploded, folded to
(hash, count) and dealt to buckets by the leading bits of the hash, so a bucket holds every count of its
n-grams. Buckets add the counts up and answer each block with the totals of the n-grams it asked for, in the
order in which it asked. Blocks then sum the scores of their documents.

A frequent n-gram reaches its bucket once per block, not once per occurrence. Blocks and buckets are of a
stated size, and their number follows the input.

The model of a document leaves its own counts out. Word w after v scores  c(v w) / c(v)  if the rest of the
corpus has "v w", else  BACKOFF * c(w) / N , and a word seen nowhere else counts as BACKOFF occurrences.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import table
from orrery.llm.quality import words_of

BACKOFF = 0.4
WORDS_PER_BLOCK = 200_000
NGRAMS_PER_BUCKET = 1_000_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        # An even hash marks a single word, an odd one a pair.
        self[word] = h = xxhash.xxh64_intdigest(word) & ~1
        return h


def words_hashed(text: str | None, known: dict) -> np.ndarray:
    """Hashes of the words, A-Z lower-cased."""
    found = (text or "").encode().lower().split()
    return np.fromiter(map(known.__getitem__, found), np.uint64, len(found))


def pair_hashes(words: np.ndarray) -> np.ndarray:
    """Hash of each word with the one before it; one shorter than ``words``."""
    h = words[:-1] * np.uint64(0x9E3779B97F4A7C15) + (words[1:] ^ (words[1:] >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x165667B19E3779F9)
    return (h ^ (h >> np.uint64(32))) | np.uint64(1)


def _packed(counts: np.ndarray) -> bytes:
    """Counts as single bytes, those from 255 up as 255 with their values at the end; most n-grams are rare."""
    large = counts >= 255
    return np.int64(len(counts)).tobytes() + np.where(large, 255, counts).astype(np.uint8).tobytes() + counts[large].astype(np.int64).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    counts = np.frombuffer(data, np.uint8, n, 8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, np.int64, -1, 8 + n)
    return counts


def _packed_keys(keys: np.ndarray) -> bytes:
    """Ascending hashes as differences of six bytes; larger ones as all ones, with their values at the end."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    escape = np.uint64((1 << 48) - 1)
    large = steps >= escape
    short = np.where(large, escape, steps).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    return np.int64(len(keys)).tobytes() + short.tobytes() + steps[large].tobytes()


def _unpacked_keys(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    steps = np.zeros((n, 8), np.uint8)
    steps[:, :6] = np.frombuffer(data, np.uint8, 6 * n, 8).reshape(n, 6)
    steps = steps.view("<u8").ravel()
    steps[steps == (1 << 48) - 1] = np.frombuffer(data, "<u8", -1, 8 + 6 * n)
    return np.cumsum(steps, dtype=np.uint64)


def _folded(texts: list[str | None], known: dict) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(hashes of the words of each text, n-grams of the block in ascending order, their counts)."""
    words = [words_hashed(t, known) for t in texts]
    all_ = [*words, *(pair_hashes(w) for w in words if len(w) > 1)]
    return words, *np.unique(np.concatenate(all_) if all_ else np.empty(0, np.uint64), return_counts=True)


def _score(words: np.ndarray, keys: np.ndarray, totals: np.ndarray, total_words: int, backoff: float) -> tuple[float, int]:
    """(sum of log scores, words whose pair the rest of the corpus has)."""
    if not len(words):
        return 0.0, 0

    def others(h: np.ndarray) -> np.ndarray:
        _, back, own = np.unique(h, return_inverse=True, return_counts=True)
        return (totals[np.searchsorted(keys, h)] - own[back]).astype(np.float64)

    one = others(words)
    score = np.log(backoff * np.maximum(one, backoff) / max(total_words - len(words), 1))
    score[0] -= np.log(backoff)  # nothing stands before the first word: no step back
    seen = 0
    if len(words) > 1:
        two = others(pair_hashes(words))
        known = two > 0
        score[1:][known] = np.log(two[known] / one[:-1][known])
        seen = int(known.sum())
    return float(score.sum()), seen


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", backoff: float = BACKOFF, words_per_block: int = WORDS_PER_BLOCK, ngrams_per_bucket: int = NGRAMS_PER_BUCKET) -> DataFrame:
    """(id, n_words, n_seen, score, mean_score): log score of each text, natural logarithm, one row per row of ``docs``.

    n_seen counts the words scored by a pair. A text without words (null, empty, blank) scores 0 and has a null
    mean. Rows with null or repeated ids stay; rows alike in id and text share a block. Counts cover all rows,
    copies included. An empty table gives an empty result; other columns are left out.
    """
    text = F.col(text_col).cast("string")
    total = docs.agg(F.sum(F.size(words_of(text)))).first()[0] or 0
    blocks = max(1, -(-total // words_per_block))
    bits = max(0, (2 * total // ngrams_per_bucket).bit_length())
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks))).repartition("block")
    id_field = dealt.select("id").schema

    def ask(t: pa.Table) -> pa.Table:
        _, keys, counts = _folded(t.column("text").to_pylist(), _Hashes())
        bucket = keys >> np.uint64(64 - bits) if bits else np.zeros(len(keys), np.uint64)
        names, first = np.unique(bucket, return_index=True)
        edges = [*first.tolist(), len(keys)]
        part = lambda a, put: pa.array([put(a[x:y]) for x, y in zip(edges, edges[1:], strict=False)], pa.binary())
        block = pa.array([t.column("block")[0].as_py()] * len(names), pa.int64())
        return pa.table({"block": block, "bucket": pa.array(names.astype(np.int64)), "keys": part(keys, _packed_keys), "counts": part(counts, _packed)})

    asked = dealt.groupBy("block").applyInArrow(ask, "block long, bucket long, keys binary, counts binary")

    def answer(t: pa.Table) -> pa.Table:
        keys = [_unpacked_keys(x) for x in t.column("keys").to_pylist()]
        counts = np.concatenate([_unpacked(x) for x in t.column("counts").to_pylist()])
        _, back = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(back, counts).astype(np.int64)[back]
        edges = np.cumsum([0, *map(len, keys)]).tolist()
        parts = [_packed(totals[x:y]) for x, y in zip(edges, edges[1:], strict=False)]
        return pa.table({"block": t.column("block"), "bucket": t.column("bucket"), "totals": pa.array(parts, pa.binary())})

    answers = asked.groupBy("bucket").applyInArrow(answer, "block long, bucket long, totals binary")
    schema = id_field.add("n_words", "long").add("n_seen", "long").add("score", "double")
    names = schema.names

    def score(texts: pa.Table, totals: pa.Table) -> pa.Table:
        words, keys, _ = _folded(texts.column("text").to_pylist(), _Hashes())
        order = np.argsort(totals.column("bucket").to_numpy())
        parts = totals.column("totals").to_pylist()
        counts = np.concatenate([_unpacked(parts[k]) for k in order]) if len(order) else np.empty(0, np.int64)
        found = [_score(w, keys, counts, total, backoff) for w in words]
        cols = [texts.column("id"), pa.array([len(w) for w in words], pa.int64()), pa.array([f[1] for f in found], pa.int64()), pa.array([f[0] for f in found], pa.float64())]
        return pa.table(dict(zip(names, cols, strict=True)))

    found = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, schema)
    return found.withColumn("mean_score", F.when(F.col("n_words") > 0, F.col("score") / F.col("n_words"))).withColumnRenamed("id", id_col)


def op5(spark, sf_dir: str) -> DataFrame:
    found = scored(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_seen", F.round("score", 4).alias("score"), F.round("mean_score", 6).alias("mean_score"))


OP5_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
k AS (SELECT rid, i, w[i] AS x, CASE WHEN i > 1 THEN w[i - 1] END AS before FROM (SELECT rid, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
c AS (SELECT *, count(*) OVER () AS total, count(*) OVER (PARTITION BY rid) AS own, count(*) OVER (PARTITION BY x) - count(*) OVER (PARTITION BY x, rid) AS one,
  count(before) OVER (PARTITION BY before, x) - count(before) OVER (PARTITION BY before, x, rid) AS two FROM k),
s AS (SELECT rid, two > 0 AS seen, CASE WHEN two > 0 THEN ln(two / lag(one) OVER (PARTITION BY rid ORDER BY i))
  ELSE ln(CASE WHEN i > 1 THEN {BACKOFF}::DOUBLE ELSE 1 END * greatest(one, {BACKOFF}::DOUBLE) / greatest(total - own, 1)) END AS score FROM c)
SELECT doc_id, len(w)::BIGINT AS n_words, count_if(seen)::BIGINT AS n_seen, round(coalesce(sum(score), 0), 4) AS score, round(avg(score), 6) AS mean_score
FROM d LEFT JOIN s USING (rid) GROUP BY rid, doc_id, w
"""
