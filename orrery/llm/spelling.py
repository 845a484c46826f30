"""Spelling variants: words that differ by one inserted, deleted or replaced letter, found by pairs of trie nodes.

Every beginning of a word is a node of a trie of all words, every ending a node of a trie of all reversed words;
nodes are numbered. A pair (beginning, ending) that skips one position of a word stands for all words with any
letter there, and the pair that skips nothing for the word itself:

    two words share a skipping pair               one letter is replaced
    a word's skipping pair is another's whole one one letter is deleted from the first, inserted into the second

A join on these integer pairs is exact and compares no strings. A word that repeats a letter gives the same
rest for each of them, so only the first of equal neighbours counts as deleted.

Nodes are numbered without a table of nodes. The first letters of a word are a number as they are, with as many
digits as 62 bits hold for the letters in use. Words are dealt by one letter more; among those that share it, sorted,
a longer beginning is new where it differs from the word before, and gets a running number.

Pairs of words are never listed. The rows of a node pair are at most one per letter of the alphabet and one per
word, and a window over them gives each row the number of its partners and the most frequent one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.llm.common import settled, table
from orrery.llm.resampling import CRC_SQL, crc_sql
from orrery.operators.keys import dense_key

RUN = re.compile(r"[a-zÀ-ÿ]+")
MIN_LETTERS = 5
MIN_COUNT = 3
TIMES = 2
#: One run of a document in so many loses a letter, decided by a checksum.
ONE_IN = 97
#: Bits of a node that is numbered by its letters.
NODE_BITS = 62
WORDS_PER_BUCKET = 500_000
#: Words that a task counts before it sends them on, letters in a batch of numbered words.
WORDS_HELD = 200_000
LETTERS_AT_ONCE = 1 << 20


def spoiled_runs(text: str | None, id_: int | None) -> Iterator[tuple[str, int]]:
    """(word, count): the letter runs of a text, A-Z lower-cased, some of them with one letter missing."""
    start = crc32(f"{'' if id_ is None else id_}:".encode())
    for run, n in Counter(RUN.findall((text or "").encode().lower().decode())).items():
        h = crc32(run.encode(), start)
        if h % ONE_IN == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= MIN_LETTERS:
            yield run, n


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) over all rows; a null text has no words, a null id counts as an empty one. Tasks add up before the shuffle."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return batch

        for b in batches:
            for id_, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for word, n in spoiled_runs(text, id_):
                    held[word] = held.get(word, 0) + n
                if len(held) >= WORDS_HELD:
                    yield out()
        yield out()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(of_batches, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _shared(a: str, b: str) -> int:
    """How many letters two words have in common at their beginning."""
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:  # by halves: beginnings may be long
        mid = (low + high + 1) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def alphabet(words: DataFrame) -> dict[str, int]:
    """The different letters of all words, numbered from 1; at most as many as there are code points."""
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).distinct()
    return {r.letter: k for k, r in enumerate(letters.orderBy("letter").collect(), 1)}


def _with_nodes(words: DataFrame, name: str, backwards: bool, letters: dict[str, int]) -> DataFrame:
    """``words`` (column word) with an array ``name``: entry k is the node of the first k letters.

    Backwards: of the letters from k to the end. Nodes of more letters than ``NODE_BITS`` hold have negative numbers, made
    of the partition and a running number; words that share such a node share a partition and lie together in it.
    """
    bits = max(1, len(letters).bit_length())
    shallow = NODE_BITS // bits
    spelt = F.reverse("word") if backwards else F.col("word")
    dealt = words.withColumn("spelt", spelt).repartition(F.substring("spelt", 1, shallow + 1)).sortWithinPartitions("spelt")
    schema = T.StructType([*words.schema.fields, T.StructField(name, T.ArrayType(T.LongType()))])

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new = -1 - (TaskContext.get().partitionId() << 40)
        last, stack = "", [0]
        for b in batches:
            spelt = b.column("spelt").to_pylist()
            at, nodes, size = 0, [], 0
            for k, word in enumerate(spelt):
                del stack[_shared(last, word) + 1 :]
                for depth in range(len(stack), len(word) + 1):
                    if depth <= shallow:
                        stack.append(stack[-1] << bits | letters[word[depth - 1]])
                    else:
                        stack.append(new)
                        new -= 1
                last = word
                nodes.append(stack[::-1] if backwards else stack[:])
                size += len(word)
                if size >= LETTERS_AT_ONCE or k == len(spelt) - 1:
                    yield _extended(b.slice(at, len(nodes)), nodes, schema.names)
                    at, nodes, size = at + len(nodes), [], 0

    return dealt.mapInArrow(of_batches, schema)


def _extended(batch: pa.RecordBatch, nodes: list[list[int]], names: list[str]) -> pa.RecordBatch:
    cols = [batch.column(c) for c in names[:-1]]
    return pa.RecordBatch.from_arrays([*cols, pa.array(nodes, pa.list_(pa.int64()))], names)


def _near(words: DataFrame) -> DataFrame:
    """(place, n_near, best): how many words are near each word and the least place among them. ``words``: (word, place).

    Words without a near one may be missing.
    """
    letters = alphabet(words)
    numbered = _with_nodes(_with_nodes(words, "heads", False, letters), "tails", True, letters)
    same_as_before = F.expr("transform(sequence(0, length(word) - 1), i -> if(i > 0, spelt[i] = spelt[i - 1], false))")
    entry = "named_struct('head', heads[i], 'tail', tails[i + 1], 'gap', true, 'first', not twice[i])"
    whole = "named_struct('head', heads[i], 'tail', tails[i], 'gap', false, 'first', false)"
    rows = numbered.withColumn("spelt", F.split("word", "")).withColumn("twice", same_as_before)
    rows = rows.select("place", F.inline(F.expr(f"concat(transform(sequence(0, length(word) - 1), i -> {entry}), transform(sequence(0, length(word)), i -> {whole}))")))
    pair = Window.partitionBy("head", "tail")
    ranked = pair.orderBy(F.col("gap").desc(), "place")
    of = lambda cond, value: F.when(cond, value)
    gap, first = F.col("gap"), F.col("first")
    rows = rows.select(
        "place", "gap", "first",
        F.count(of(gap, 1)).over(pair).alias("gaps"), F.count(of(first, 1)).over(pair).alias("longer"),
        F.min(of(gap, F.col("place"))).over(pair).alias("least"), F.min(of(first, F.col("place"))).over(pair).alias("least_longer"),
        F.min(of(~gap, F.col("place"))).over(pair).alias("rest"), F.lead(of(gap, F.col("place"))).over(ranked).alias("next"),
    )
    # The row of the least place looks at the next one instead; `rest` is the word that a skipping pair leaves.
    other = F.when(F.col("least") == F.col("place"), F.col("next")).otherwise(F.col("least"))
    shorter = F.when(first, F.col("rest"))
    found = rows.select(
        "place",
        F.when(gap, F.col("gaps") - 1 + F.when(shorter.isNotNull(), 1).otherwise(0)).otherwise(F.col("longer")).alias("n_near"),
        F.when(gap, F.least(other, shorter)).otherwise(F.col("least_longer")).alias("best"),
    )
    return found.where("n_near > 0").groupBy("place").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def _roots(words: DataFrame) -> DataFrame:
    """(place, root) of (place, form_place): the end of each chain of forms, by jumps of twice the length each round.

    Chains are short, as each form is ``TIMES`` times as frequent as the one before.
    """
    at = settled(words.select("place", F.coalesce("form_place", "place").alias("root")))
    while True:
        onward = at.select(F.col("place").alias("root"), F.col("root").alias("beyond"))
        jumped = settled(at.join(onward, "root").select("place", F.col("beyond").alias("root"), (F.col("root") != F.col("beyond")).alias("moved")))
        if jumped.where("moved").isEmpty():
            return at
        at = jumped.select("place", "root")


def variants(counted: DataFrame, word_col: str = "word", n_col: str = "n", times: int = TIMES) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of a table of different words and their counts, one row per word.

    ``n_near`` counts the words at one inserted, deleted or replaced letter. ``form`` is the most frequent of
    them (of equal ones the first in code-point order) if it is ``times`` as frequent or more, ``root`` the last of
    the chain of forms, the word itself without one. Null and empty words are left out, repeated words are
    added up, a null count is 0. Other columns are left out; an empty table gives an empty result.
    """
    rows = counted.where(F.length(word_col) > 0).groupBy(F.col(word_col).cast("string").alias("word"))
    rows = settled(rows.agg(F.sum(F.coalesce(F.col(n_col).cast("long"), F.lit(0).cast("long"))).alias("n")))
    # Places by falling count and code points: the best of some words is the one with the least place.
    ordered = rows.withColumn("rarity", -F.col("n"))
    places = settled(dense_key(ordered, "rarity", "place", ["word"], keys_per_bucket=WORDS_PER_BUCKET, key_type="bigint").drop("rarity"))
    near = places.join(_near(places.select("word", "place")), "place", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0).cast("long")))
    best = places.select(F.col("place").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    found = near.join(best, "best", "left").withColumn("holds", F.coalesce(F.col("form_n") >= F.col("n") * times, F.lit(False)))
    kept = lambda name, c: F.when(F.col("holds"), F.col(c)).alias(name)
    found = settled(found.select("place", "word", "n", "n_near", kept("form", "form"), kept("form_n", "form_n"), kept("form_place", "best")))
    ends = _roots(found.select("place", "form_place"))
    names = places.select(F.col("place").alias("root_place"), F.col("word").alias("root"))
    out = found.join(ends.withColumnRenamed("root", "root_place"), "place").join(names, "root_place")
    return out.select("word", "n", "n_near", "form", "form_n", "root")


def op11(spark, sf_dir: str) -> DataFrame:
    words = word_counts(table(spark, sf_dir, "documents")).where(F.col("n") >= MIN_COUNT)
    return variants(words)


OP11_SQL = rf"""
WITH RECURSIVE {CRC_SQL.strip()},
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
hashed AS (SELECT run, c, {crc_sql("doc_id || ':' || run")} AS h FROM (SELECT doc_id, run, count(*) AS c FROM runs GROUP BY ALL), steps),
spelt AS (SELECT CASE WHEN h % {ONE_IN} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM hashed),
words AS (SELECT word, sum(c)::BIGINT AS n FROM spelt WHERE length(word) >= {MIN_LETTERS} GROUP BY word HAVING sum(c) >= {MIN_COUNT}),
gaps AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (SELECT a.word, b.word AS other FROM gaps a JOIN gaps b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT g.word, w.word FROM gaps g JOIN words w ON g.rest = w.word UNION SELECT w.word, g.word FROM gaps g JOIN words w ON g.rest = w.word),
best AS (SELECT near.word, count(*) OVER (PARTITION BY near.word) AS n_near, other, n AS other_n, row_number() OVER (PARTITION BY near.word ORDER BY n DESC, other) AS k FROM near JOIN words ON other = words.word),
forms AS (SELECT words.word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= {TIMES} * n THEN other END AS form, CASE WHEN other_n >= {TIMES} * n THEN other_n END AS form_n
  FROM words LEFT JOIN best ON words.word = best.word AND k = 1),
chain AS (SELECT word, word AS root, form AS onward FROM forms UNION ALL SELECT chain.word, forms.word, forms.form FROM chain JOIN forms ON chain.onward = forms.word)
SELECT word, n, n_near, form, form_n, root FROM forms JOIN (SELECT word, root FROM chain WHERE onward IS NULL) USING (word)
"""
