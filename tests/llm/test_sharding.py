from collections import Counter

import duckdb
from pyspark.sql import functions as F

from llm_fixtures import docs, none  # noqa: F401
from orrery.llm import sharding


def test_counts_differ_by_one_and_mixture_holds(spark):
    df = spark.range(4003).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"))
    rows = sharding.deal(df, 40).collect()
    size = Counter(r.shard for r in rows)
    assert len(rows) == 4003 and set(size) == set(range(40)) and max(size.values()) - min(size.values()) <= 1
    for s in range(40):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(size[s]))
    hot = Counter(r.shard for r in rows if r.source == "hot")
    assert max(hot.values()) - min(hot.values()) <= 8  # of the number of strata, whatever the size


def test_result_does_not_depend_on_partitions_or_buckets(spark, monkeypatch):
    df = spark.range(2000).select("id", (F.col("id") % 5).cast("string").alias("source"))
    first = {r.id: (r.shard, r.slot) for r in sharding.deal(df, 7).collect()}
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 100)
    second = {r.id: (r.shard, r.slot) for r in sharding.deal(df.repartition(13), 7).collect()}
    assert first == second


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS FROM '{folder}/documents.parquet'")
    want = duckdb.sql(sharding.OP4_SQL)
    got = sharding.op4(spark, folder).select(*want.columns)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.fetchall()))


def test_clashing_names_get_an_underscore(spark):
    rows = spark.createDataFrame([(k, "s", 1, 2, 3, 4) for k in range(50)], "doc_id long, source string, shard int, Slot int, _d_n int, c0 int")
    dealt = sharding.deal(rows, 4)
    assert dealt.columns == ["doc_id", "source", "shard", "Slot", "_d_n", "c0", "shard_", "slot_"]
    assert {(r.shard, r.Slot, r._d_n, r.c0) for r in dealt.collect()} == {(1, 2, 3, 4)}
    assert Counter(r.shard_ for r in dealt.collect()) == {0: 13, 1: 12, 2: 13, 3: 12}


def test_null_strata_repeated_rows_and_one_row_more(spark):
    df = spark.createDataFrame([(None, None)] * 25_000 + [(1, "a")] * 3 + [(2, None)], "doc_id long, source string")
    rows = sharding.deal(df, 4).collect()
    size = Counter(r.shard for r in rows)
    assert len(rows) == 25_004 and max(size.values()) - min(size.values()) <= 1
    assert len({(r.shard, r.slot) for r in rows}) == 25_004


def test_fewer_rows_than_shards_and_none(spark, none):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, source string")
    assert len({r.shard for r in sharding.deal(df, 40).collect()}) == 2
    assert sharding.deal(none, 40).count() == 0


def test_shards_are_written_whole(docs, tmp_path, spark):
    sharding.write_shards(docs, str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count()
    assert sorted(map(str, (r.text for r in back.collect()))) == sorted(map(str, (r.text for r in docs.collect())))


def test_the_query_spreads_sources_of_one_row(spark, tmp_path):
    """A third of the documents are the only ones of their source; op4 itself has to spread them."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("site"), "id")).otherwise("big").alias("source"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    small = Counter(r.shard for r in sharding.op4(spark, str(tmp_path)).collect() if r.source != "big")
    assert len(small) == 40 and max(small.values()) < 50


def test_many_sources_of_one_row_spread_over_shards_and_buckets(spark, monkeypatch):
    df = spark.range(6000).select("id", F.when(F.col("id") < 2000, F.concat(F.lit("site"), "id")).otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("source"))
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 500)
    small = Counter(r.shard for r in sharding.deal(df, 40).collect() if r.id < 2000)
    assert len(small) == 40 and min(small.values()) > 25 and max(small.values()) < 75
