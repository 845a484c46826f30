"""Proportional stratified interleaving: rows dealt into shards so that each shard has the mixture of the whole.

Rows are shuffled by a seeded hash and ranked within their stratum. Rank k of n becomes the fraction
(k + u) / n with a seeded hash u of the stratum in [0, 1), and rows are lined up by fraction, so at any point
of the line every stratum is used up in proportion, and strata with a row or two are spread over the line.
The line is cut into shards whose row counts differ by one at most (the law ``rows``).

Neither rank is taken in one task: hash values and fractions are spread evenly, so fixed ranges of them are
buckets of like size, ranked on their own and shifted by the counts of the buckets before. The number of buckets
follows the row count. Equal rows are folded to one with a count first, so copies share no bucket's burden.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.common import free_name, settled, table

SHARDS = 40
SEED = "orrery"
ROWS_PER_BUCKET = 50_000
_COPIES_AT_ONCE = 10_000


def _bits(rows: int) -> int:
    """Bits of the bucket number; 28 bits are 1e13 rows, and beyond that buckets grow."""
    return min(28, max(0, (rows // ROWS_PER_BUCKET).bit_length()))


def _offset(stratum: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the seed and the stratum; a null stratum has its own."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), stratum.isNull().cast("string"), F.coalesce(stratum.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / float(1 << 32)


def deal(rows: DataFrame, shards: int, stratum_col: str = "source", seed: str = SEED) -> DataFrame:
    """``rows`` with shard (int, 0 to shards - 1) and slot (long, gapless from 0 in each shard).

    Every column of ``rows`` must allow grouping; all of them decide the shuffled order, so the result
    depends on content alone. Nulls are values like any other, in the stratum as well. Equal rows get
    neighbouring ranks. An empty table gives an empty result; if ``rows`` has a column named shard or
    slot, the new one gets an underscore.
    """
    names = rows.columns
    out = {n: free_name(rows, n) for n in ("shard", "slot")}
    stratum_at = [n.lower() for n in names].index(stratum_col.lower())
    rows = rows.toDF(*(f"c{k}" for k in range(len(names))))
    own = [F.col(c) for c in rows.columns]
    stratum = own[stratum_at]
    text = [F.coalesce(c.cast("string"), F.lit("")) for c in own]
    digest = F.md5(F.concat_ws(":", F.lit(seed), *text))
    found = settled(rows.groupBy(*own).agg(F.count("*").alias("_d_n")).withColumn("_d_hash", digest))
    total = found.agg(F.sum("_d_n")).first()[0] or 0
    bits = _bits(total)
    found = found.withColumn("_d_bucket", F.shiftright(F.conv(F.substring("_d_hash", 1, 7), 16, 10).cast("long"), 28 - bits))

    before = Window.partitionBy("_d_s").orderBy("_d_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = found.groupBy(stratum.alias("_d_s"), F.col("_d_bucket").alias("_d_b")).agg(F.sum("_d_n").alias("_d_size"))
    sizes = sizes.withColumn("_d_skip", F.coalesce(F.sum("_d_size").over(before), F.lit(0))).withColumn("_d_all", F.sum("_d_size").over(Window.partitionBy("_d_s")))
    in_bucket = Window.partitionBy(stratum, "_d_bucket").orderBy("_d_hash", *own).rowsBetween(Window.unboundedPreceding, -1)
    ranked = found.withColumn("_d_ahead", F.coalesce(F.sum("_d_n").over(in_bucket), F.lit(0)))
    ranked = ranked.join(sizes, stratum.eqNullSafe(F.col("_d_s")) & (F.col("_d_bucket") == F.col("_d_b")))
    # Copies of a row, in two steps so that no array holds all of them.
    ranked = ranked.withColumn("_d_first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_d_n") - 1, F.lit(_COPIES_AT_ONCE).cast("long"))))
    ranked = ranked.withColumn("_d_copy", F.explode(F.sequence("_d_first", F.least(F.col("_d_first") + _COPIES_AT_ONCE - 1, F.col("_d_n") - 1))))
    rank = F.col("_d_skip") + F.col("_d_ahead") + F.col("_d_copy")
    lined = ranked.select(*own, rank.alias("_d_rank"), ((rank + _offset(stratum, seed)) / F.col("_d_all")).alias("_d_at"))
    lined = lined.withColumn("_d_part", F.floor(F.col("_d_at") * (1 << bits)))

    parts = lined.groupBy(F.col("_d_part").alias("_d_p")).count()
    so_far = Window.orderBy("_d_p").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    parts = parts.withColumn("_d_skip", F.coalesce(F.sum("count").over(so_far), F.lit(0)))
    in_part = Window.partitionBy("_d_part").orderBy("_d_at", stratum, "_d_rank")
    placed = lined.withColumn("_d_ahead", F.row_number().over(in_part) - 1).join(parts, F.col("_d_part") == F.col("_d_p"))
    placed = placed.withColumn("_d_place", (F.col("_d_skip") + F.col("_d_ahead")).cast("long"))
    shard = F.expr(f"cast(_d_place * {shards}L div {max(total, 1)}L as int)")
    first = F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")
    placed = placed.select(*own, "_d_place", shard.alias("shard")).select(*own, "shard", (F.col("_d_place") - first).alias("slot"))
    return placed.toDF(*names, out["shard"], out["slot"])


def write_shards(rows: DataFrame, path: str, shards: int, stratum_col: str = "source", seed: str = SEED) -> None:
    """Whole rows dealt and written below ``path``, a folder per shard, each in slot order."""
    dealt = deal(rows, shards, stratum_col, seed)
    shard, slot = dealt.columns[-2:]
    dealt.repartitionByRange(shard, slot).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)


def op4(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    whole = F.coalesce("text", F.lit(""))
    narrow = docs.select("doc_id", "source", (F.octet_length(whole) + 16).cast("long").alias("size"), F.crc32(whole.cast("binary")).alias("text_crc32"))
    none = F.lit(None).cast("int")
    return deal(narrow, SHARDS).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", none.alias("grown_shard"), "source")


#: The table of CRC-32 is built from its polynomial; the checksum then folds the bytes of the text.
OP4_SQL = f"""
WITH step AS (
  SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) AS v
  FROM (SELECT unnest(range(256))::BIGINT AS i)
), crc AS (SELECT list(v ORDER BY i) AS t FROM step),
docs AS (
  SELECT doc_id, source, hex(encode(coalesce(text, ''))) AS h FROM documents
), base AS (
  SELECT doc_id, source, (length(h) // 2 + 16)::BIGINT AS size,
    xor(4294967295, list_reduce(list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, (2 * i + 1)::BIGINT, 2))::BIGINT),
      lambda c, b: xor(c // 256, t[(xor(c % 256, b) + 1)::BIGINT]), 4294967295))::BIGINT AS text_crc32
  FROM docs, crc
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(source, '') || ':' || size || ':' || text_crc32), doc_id NULLS FIRST, size, text_crc32) - 1 AS r,
    count(*) OVER (PARTITION BY source) AS n, count(*) OVER () AS total
  FROM base
), placed AS (
  SELECT *, row_number() OVER (ORDER BY (r + ('0x' || substr(md5('{SEED}:' || (source IS NULL) || ':' || coalesce(source, '')), 1, 8))::BIGINT / 4294967296::DOUBLE) / n, source NULLS FIRST, r) - 1 AS place FROM ranked
)
SELECT doc_id, size, text_crc32, 'rows' AS law, (place * {SHARDS} // total)::INT AS shard,
  (place - ((place * {SHARDS} // total) * total + {SHARDS - 1}) // {SHARDS})::BIGINT AS slot, NULL::INT AS grown_shard, source
FROM placed
"""
