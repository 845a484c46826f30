"""Quality rules whose cut-offs come from the data: a quantile sketch per language and source.

The sketch is a histogram over logarithmic buckets with five significant bits. Sketches merge by adding
counts, so they fold inside each task before the shuffle, and a source's sketches add up to its language's.
A value fails if it lies beyond a fence: a high quantile of the measure plus a multiple of its distance from the
median, both taken at the ends of their buckets, so that no fence is narrower than the sketch can tell. The quantile is the share of documents that a measure is expected to leave alone in any stratum; where
the fence then lies, the stratum alone decides. The sketch of a stratum is read together with that of its
language, which weighs as much as ``PRIOR`` documents: it decides for a stratum of a few documents and has
hardly any influence on one of thousands, without a switch between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.common import SPACES, free_name, settled, table

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
PRIOR = 20
#: Measures (integers): the side that is bad, the quantile in percent, and how often its distance from the median counts.
MEASURES = {
    "symbol_share": ("high", 90, 3),
    "dup_line_share": ("high", 99, 2),
    "repeat_share": ("high", 99, 2),
    "word_length": ("both", 90, 6),
}


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, whatever the optimizer inlines."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Runs of characters other than ASCII white space; none for null."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(F.coalesce(trimmed, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t-\\r]+"))


def _repeat_words(words: Column) -> Column:
    """Words covered by a 3-word window that the text has twice or more.

    Windows are compared by a 64-bit hash: sorted with their positions, equal neighbours are repeats.
    """

    def marked(w: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p")))
        return let(F.sort_array(windows), covered)

    def covered(s: Column) -> Column:
        same = lambda x, i: F.coalesce(F.get(s, i)["h"] == x["h"], F.lit(False))
        twice = F.filter(s, lambda x, i: same(x, i + 1) | same(x, i - 1))
        return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2)))))

    return F.when(F.size(words) < 3, F.lit(0)).otherwise(marked(words))


def _dup_lines(text: Column) -> Column:
    """(lines with a word, those equal to an earlier one)."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    return let(lines, lambda x: F.struct(F.size(x).alias("lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct ``measures``: the base counts and the four measures, all integers. Null text counts as empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    kept = lambda drop: F.length(F.translate(text, drop, "")).cast("long")
    counts = let(words_of(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeat_words(w).cast("long").alias("n_repeat_words")))
    lines = _dup_lines(text)
    base = F.struct(counts.alias("c"), kept(SPACES).alias("word_chars"), (F.length(text) - kept(SYMBOLS)).alias("n_symbols"), lines.alias("l"))

    def all_of(b: Column) -> Column:
        n, chars, repeats = b["c"]["n_words"], b["word_chars"], b["c"]["n_repeat_words"]
        whole = lambda a, d: F.floor(a / F.greatest(d, F.lit(1))).cast("long")
        return F.struct(
            n.alias("n_words"), chars.alias("word_chars"), b["n_symbols"].alias("n_symbols"), b["l"]["dup"].cast("long").alias("n_dup_lines"), repeats.alias("n_repeat_words"),
            whole(b["n_symbols"] * 10000, chars).alias("symbol_share"), whole(b["l"]["dup"].cast("long") * 10000, b["l"]["lines"]).alias("dup_line_share"),
            whole(repeats * 10000, n).alias("repeat_share"), whole(chars * 100, n).alias("word_length"),
        )

    return docs.withColumn(free_name(docs, "measures"), let(base, all_of))


def bucket(x: Column) -> Column:
    """Bucket of a non-negative integer; below 64 its value, beyond that five bits after the leading one."""
    over = F.length(F.bin(x)) - 6
    return F.when(x < 64, x).otherwise(over * 32 + F.floor(x / F.pow(F.lit(2.0), over)).cast("long")).cast("long")


def lower_end(b: Column) -> Column:
    """Smallest integer of a bucket."""
    over = F.floor(b / 32) - 1
    return F.when(b < 64, b).otherwise(((b - over * 32) * F.pow(F.lit(2.0), over)).cast("long")).cast("long")


def sketches(measures: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    """(lang, source, measure, bucket, n): the mergeable sketch of each stratum, from a column ``measures``."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), bucket(F.col(f"measures.{m}")).alias("bucket")) for m in MEASURES]))
    return measures.select(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), each.alias("e")).groupBy("lang", "source", F.col("e.measure").alias("measure"), F.col("e.bucket").alias("bucket")).agg(F.count("*").alias("n"))


def upper_end(b: Column) -> Column:
    """Largest integer of a bucket."""
    return lower_end(b + 1) - 1


def fences(sketch: DataFrame) -> DataFrame:
    """(lang, source, fence) for each stratum of the sketch; ``sketch`` should be a written table, as it is read three times."""
    by = ["lang", "source", "measure"]
    of_lang = sketch.groupBy("lang", "measure", "bucket").agg(F.sum("n").alias("n"))
    docs = of_lang.groupBy("lang", "measure").agg(F.sum("n").alias("docs"))
    named = lambda df: df.withColumnsRenamed({"lang": "lang_", "measure": "measure_"})
    same = F.col("lang").eqNullSafe(F.col("lang_")) & (F.col("measure") == F.col("measure_"))
    weight = lambda c: c.cast("decimal(19,0)")
    # Both sides in whole numbers: n of the stratum and PRIOR times the share of the language's documents.
    own = sketch.join(named(docs), same).select(*by, "bucket", (weight(F.col("n")) * weight(F.col("docs"))).alias("w"))
    prior = sketch.select(*by).distinct().join(named(of_lang), same).select(*by, "bucket", (weight(F.col("n")) * F.lit(PRIOR)).alias("w"))
    merged = own.unionByName(prior.withColumn("w", F.col("w").cast(own.schema["w"].dataType))).groupBy(*by, "bucket").agg(F.sum("w").alias("w"))
    stratum = Window.partitionBy(*by)
    ranked = merged.withColumn("upto", F.sum("w").over(stratum.orderBy("bucket"))).withColumn("all", F.sum("w").over(stratum))
    level = F.element_at(F.create_map(*[F.lit(x) for m, (_, p, _) in MEASURES.items() for x in (m, p)]), F.col("measure"))
    reach = F.element_at(F.create_map(*[F.lit(x) for m, (_, _, r) in MEASURES.items() for x in (m, r)]), F.col("measure"))
    at = lambda percent: F.min(F.when(F.col("upto") * 100 >= F.col("all") * percent, F.col("bucket")))
    ends = ranked.withColumn("level", level).groupBy(*by).agg(at(F.lit(50)).alias("middle"), at(F.col("level")).alias("top"), at(100 - F.col("level")).alias("bottom"))
    top, bottom = upper_end(F.col("top")), lower_end(F.col("bottom"))
    below, above = lower_end(F.col("middle")), upper_end(F.col("middle"))
    ends = ends.select(*by, (bottom - (above - bottom) * reach).alias("low"), (top + (top - below) * reach).alias("high"))
    pick = lambda m, end: F.max(F.when(F.col("measure") == m, F.col(end))).cast("double").alias(f"{m}_{end}")
    return ends.groupBy("lang", "source").agg(F.struct(*[pick(m, end) for m in MEASURES for end in ("low", "high")]).alias("fence"))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (m["n_repeat_words"] * 100 > m["n_words"] * MAX_REPEAT_PERCENT)


def limits_of(found: DataFrame, measures_col: str, lang_col: str, source_col: str) -> DataFrame:
    """Fences from the documents of ``found`` that pass the base rule.

    They are written, so that Spark knows their size when it plans the join and broadcasts them if they are
    small: then no text is shuffled for them.
    """
    m = F.col(f"`{measures_col}`")
    strata = found.where(~base_failed(m)).select(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), m.alias("measures"))
    return settled(fences(settled(sketches(strata, "lang", "source"))))


def with_verdict(found: DataFrame, limits: DataFrame, measures_col: str, verdict_col: str, lang_col: str, source_col: str) -> DataFrame:
    """``found`` with the struct ``verdict_col``: base_failed, failed (measures beyond a fence), kept."""
    names = {c: free_name(found, c) for c in ("lang_", "source_", "fence")}
    m, fence = F.col(f"`{measures_col}`"), F.col(f"`{names['fence']}`")
    limits = limits.select(F.col("lang").alias(names["lang_"]), F.col("source").alias(names["source_"]), F.col("fence").alias(names["fence"]))
    joined = found.join(limits, F.col(lang_col).eqNullSafe(F.col(names["lang_"])) & F.col(source_col).eqNullSafe(F.col(names["source_"])), "left")
    failed = base_failed(m)
    over = {k: (m[k] > fence[f"{k}_high"]) | (m[k] < fence[f"{k}_low"] if side == "both" else F.lit(False)) for k, (side, _, _) in MEASURES.items()}
    which = F.when(failed, F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in over.items()])))
    verdict = F.struct(failed.alias("base_failed"), which.alias("failed"), (~failed & (F.size(which) == 0)).alias("kept"))
    return joined.withColumn(verdict_col, verdict).drop(*names.values())


def judged(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``docs`` with structs measures and verdict (base_failed, failed: names of the measures beyond a fence, kept).

    Null text is empty and fails the base rule. Null languages and sources are strata of their own. Repeated
    rows are judged alike. Documents that fail the base rule do not enter the sketches. Columns of ``docs``
    keep their names and values; a new one whose name is taken gets an underscore. An empty table gives an
    empty result. Rows are written once beside their measures, and texts are never shuffled.
    """
    measures, verdict = free_name(docs, "measures"), free_name(docs, "verdict")
    found = settled(measured(docs, text_col))
    limits = limits_of(found, measures, lang_col, source_col)
    return with_verdict(found, limits, measures, verdict, lang_col, source_col)


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass, with their columns."""
    found = judged(docs, text_col, lang_col, source_col)
    return found.where(F.col(f"`{free_name(docs, 'verdict')}`")["kept"]).select(*[F.col(f"`{c}`") for c in docs.columns])


def op2(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    narrow = settled(measured(docs).drop("text"))
    found = with_verdict(narrow, limits_of(narrow, "measures", "lang", "source"), "measures", "verdict", "lang", "source")
    m = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select("doc_id", *[F.col(f"measures.{c}").alias(c) for c in m], F.col("verdict.base_failed").alias("base_failed"), F.col("verdict.kept").alias("kept"), F.array_join("verdict.failed", ",").alias("failed"))


def _op2_sql() -> str:
    rows = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS measure, {m} AS x FROM m WHERE NOT base_failed" for m in MEASURES)
    case = lambda k: "CASE measure " + " ".join(f"WHEN '{m}' THEN {v[k]}" for m, v in MEASURES.items()) + " END"
    low = lambda b: f"CASE WHEN {b} < 64 THEN {b} ELSE (({b}) % 32 + 32) << (({b}) // 32 - 1)::INT END"
    over = {m: f"m.{m} > f.high" + (f" OR m.{m} < f.low" if side == "both" else "") for m, (side, _, _) in MEASURES.items()}
    beyond = " ".join(f"WHEN '{m}' THEN {c}" for m, c in over.items())
    order = "CASE f.measure " + " ".join(f"WHEN '{m}' THEN {k}" for k, m in enumerate(MEASURES)) + " END"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM (SELECT rid, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w))),
r AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM g WHERE n > 1) GROUP BY rid),
b AS (SELECT rid, doc_id, lang, source, len(w)::BIGINT AS n_words, length(regexp_replace(w.t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
  length(regexp_replace(w.t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
  coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM d JOIN w USING (rid) LEFT JOIN r USING (rid)),
m AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
  n_symbols * 10000 // greatest(word_chars, 1) AS symbol_share, n_dup_lines * 10000 // greatest(n_lines, 1) AS dup_line_share,
  n_repeat_words * 10000 // greatest(n_words, 1) AS repeat_share, word_chars * 100 // greatest(n_words, 1) AS word_length FROM b),
s AS (SELECT lang, source, measure, CASE WHEN x < 64 THEN x ELSE (length(bin(x)) - 6) * 32 + (x >> (length(bin(x)) - 6)::INT) END AS bucket FROM ({rows})),
n AS (SELECT lang, source, measure, bucket, count(*)::HUGEINT AS n FROM s GROUP BY ALL),
l AS (SELECT lang, measure, bucket, sum(n) AS n FROM n GROUP BY ALL), t AS (SELECT lang, measure, sum(n) AS docs FROM n GROUP BY ALL),
u AS (SELECT n.lang, n.source, n.measure, n.bucket, n.n * t.docs AS w FROM n JOIN t ON n.lang IS NOT DISTINCT FROM t.lang AND n.measure = t.measure
  UNION ALL SELECT k.lang, k.source, k.measure, l.bucket, l.n * {PRIOR} FROM (SELECT DISTINCT lang, source, measure FROM n) k JOIN l ON k.lang IS NOT DISTINCT FROM l.lang AND k.measure = l.measure),
r2 AS (SELECT *, sum(w) OVER (PARTITION BY lang, source, measure ORDER BY bucket) AS upto, sum(w) OVER (PARTITION BY lang, source, measure) AS total
  FROM (SELECT lang, source, measure, bucket, sum(w) AS w FROM u GROUP BY ALL)),
q AS (SELECT lang, source, measure, min(bucket) FILTER (upto * 100 >= total * 50) AS middle, min(bucket) FILTER (upto * 100 >= total * ({case(1)})) AS top,
  min(bucket) FILTER (upto * 100 >= total * (100 - ({case(1)}))) AS bottom FROM r2 GROUP BY ALL),
e AS (SELECT lang, source, measure, {low("middle")} AS below, {low("middle + 1")} - 1 AS above, {low("top + 1")} - 1 AS top, {low("bottom")} AS bottom FROM q),
f AS (SELECT lang, source, measure, bottom - (above - bottom) * ({case(2)}) AS low, top + (top - below) * ({case(2)}) AS high FROM e),
v AS (SELECT m.rid, string_agg(f.measure, ',' ORDER BY {order}) AS failed FROM m JOIN f ON m.lang IS NOT DISTINCT FROM f.lang AND m.source IS NOT DISTINCT FROM f.source
  WHERE NOT base_failed AND CASE f.measure {beyond} END GROUP BY m.rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND v.failed IS NULL AS kept, coalesce(v.failed, '') AS failed
FROM m LEFT JOIN v USING (rid)
"""


OP2_SQL = _op2_sql()
