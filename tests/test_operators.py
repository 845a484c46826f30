import bisect
import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from orrery.operators.headers import require_columns, standard_headers, without_bom
from orrery.operators import keys
from orrery.operators.keys import dense_key
from orrery.operators.medians import median_per_key
from orrery.operators.ranges import RangeBuckets
from orrery.operators.reconcile import reconcile, reconcile_summary, reconcile_unique
from orrery.operators.survivors import distinct_rows, first_per_key


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def test_headers(table):
    df = table("a int, b int", (1, 2))
    assert standard_headers(df.toDF(" A ", "B")).columns == ["a", "b"]
    assert without_bom(df.toDF("﻿a", " b")).columns == ["a", "b"]
    with pytest.raises(ValueError, match="t: missing required column.s.: \\['c'\\]"):
        require_columns(df, ["a", "c"], "t")


def test_first_per_key_is_independent_of_partitioning(table):
    rows = [(k, v, s) for k in range(5) for v in (3, 1, 2) for s in ("x", "y")]
    random.Random(1).shuffle(rows)
    df = table("k int, v int, s string", *rows)
    expected = {(k, 3, "x") for k in range(5)}
    for parts in (1, 3, 7):
        kept = first_per_key(df.repartition(parts), ["k"], [F.col("v").desc()])
        assert {tuple(r) for r in kept.collect()} == expected


def test_first_per_key_limits_groups_before_the_shuffle(table):
    plan = plan_of(first_per_key(table("k int, v int", (1, 1)), ["k"], ["v"]))
    physical = plan[plan.index("Physical Plan"):]
    assert physical.index("Final") < physical.index("Exchange") < physical.index("Partial")


def test_distinct_rows(table):
    assert distinct_rows(table("a int", (1,), (1,), (None,), (None,))).count() == 2


@pytest.mark.parametrize("keys_per_bucket", [10_000, 100, 7])
def test_dense_key_equals_global_row_number(spark, keys_per_bucket):
    df = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("k"))
    keyed = dense_key(df, "k", "n", keys_per_bucket=keys_per_bucket)
    assert dict(keyed.dtypes)["n"] == "int"
    expected = df.withColumn("e", F.row_number().over(Window.orderBy("k")))
    assert keyed.join(expected, "k").where("n = e").count() == 1000


def test_dense_key_splits_a_hot_natural_key(spark):
    """A third of the rows share one natural key: the tie-breakers spread them."""
    df = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("t"),
    )
    keyed = dense_key(df, "k", "n", tie_breakers=["t"], keys_per_bucket=50)
    ordered = keyed.orderBy("k", "t").select("n")
    assert [r[0] for r in ordered.collect()] == list(range(1, 901))
    # Whatever the size, what meets in one task is a row per bucket.
    plan = plan_of(dense_key(df, "k", "n", ["t"]))
    assert "SinglePartition" not in plan or "__rows" in plan[plan.index("SinglePartition"):].split("Exchange")[0]


def test_dense_key_type_is_a_parameter(spark, monkeypatch):
    df = spark.range(10).select("id")
    assert dict(dense_key(df, "id", "n", key_type="bigint").dtypes)["n"] == "bigint"
    monkeypatch.setitem(keys._LARGEST, "int", 5)
    with pytest.raises(Exception, match="does not fit into int"):
        dense_key(df, "id", "n").collect()


def test_buckets_follow_different_keys_not_rows(spark):
    df = spark.range(2_000_000).select((F.col("id") % 2000).cast("double").alias("v"))
    buckets = RangeBuckets(df, ["v"], keys_per_bucket=120)
    assert buckets.wanted == 17 and len(buckets) >= 9
    sizes = df.groupBy(buckets.number().alias("b")).count().collect()
    assert len(sizes) == len(buckets) and max(r["count"] for r in sizes) < 2_000_000 // 4


def test_dense_key_of_nothing(table):
    assert dense_key(table("k string"), "k", "n").count() == 0


@pytest.mark.parametrize("values_per_bucket", [1_000_000, 5])
def test_median_matches_brute_force(table, values_per_bucket):
    rng = random.Random(7)
    rows = [(rng.choice("abc"), round(rng.uniform(0, 50), 2)) for _ in range(600)]
    rows += [("hot", float(rng.randint(0, 300))) for _ in range(301)] + [("one", 4.0), ("null", None)]
    medians = median_per_key(
        table("k string, v double", *rows), "k", "v", "m", values_per_bucket=values_per_bucket
    )
    got = {r["k"]: r["m"] for r in medians.collect()}
    for key in ("a", "b", "c", "hot", "one"):
        assert got[key] == pytest.approx(statistics.median(v for k, v in rows if k == key))
    assert set(got) == {"a", "b", "c", "hot", "one"}


def test_reconcile_both_directions(table):
    left = table("p string", ("a",), ("b",), ("b",), (None,))
    right = table("p string", ("b",), ("c",), ("c",), ("d",))
    assert {tuple(r) for r in reconcile(left, right, "p").collect()} == {
        ("a", "missing"), ("b", "matched"), ("c", "extra"), ("d", "extra"),
    }
    assert tuple(reconcile_summary(left, right, "p").first()) == (2, 3, 1, 2)


def test_kept_keys_survive_reloads(spark, table):
    spark.sql("DROP TABLE IF EXISTS kept")
    load = lambda *ids: {r.id: r.k for r in keys.kept_keys(table("id string, v int", *((i, 1) for i in ids)), "id", "k", "kept").collect()}
    assert load("m", "c", "x") == {"c": 1, "m": 2, "x": 3}
    # Adding one renumbers nobody, wherever it stands in the order.
    assert load("m", "a", "c", "x") == {"c": 1, "m": 2, "x": 3, "a": 4}
    assert load("x", "x", "d", None) == {"x": 3, "d": 5}
    assert load("m", "b", "z") == {"m": 2, "b": 6, "z": 7}
    assert load() == {} and spark.table("kept").count() == 7
    assert dict(spark.table("kept").dtypes)["k"] == "int"
    spark.sql("DROP TABLE kept")


def test_kept_keys_stop_at_their_type(spark, table, monkeypatch):
    spark.sql("DROP TABLE IF EXISTS kept")
    keys.kept_keys(table("id string", ("a",), ("b",)), "id", "k", "kept")
    monkeypatch.setitem(keys._LARGEST, "int", 2)
    with pytest.raises(Exception, match="does not fit into int"):
        keys.kept_keys(table("id string", ("c",)), "id", "k", "kept")
    assert spark.table("kept").count() == 2
    spark.sql("DROP TABLE kept")


def test_sketch_counts_different_keys(spark):
    for n in (0, 1, 300, 70_000, 1_000_000):
        df = spark.range(n).select(F.col("id").cast("string").alias("k")).unionByName(spark.range(5000).select(F.lit("hot").alias("k")))
        assert RangeBuckets(df, ["k"], 1000).keys == pytest.approx(n + 1, rel=0.02, abs=1)


def test_sketch_is_one_job_without_an_exchange_of_keys(spark):
    df = spark.range(300_000, numPartitions=4).select((F.col("id") % 50_000).alias("v"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("sketch", "split values")
    buckets = RangeBuckets(df, ["v"], keys_per_bucket=5000)
    jobs = tracker.getJobIdsForGroup("sketch")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 3  # the stages of one query, which AQE starts one by one
    sizes = [r["count"] for r in df.groupBy(buckets.number().alias("b")).count().collect()]
    assert len(sizes) == buckets.wanted == 10 and max(sizes) < 2 * min(sizes)


def test_reconcile_by_digests(spark, table):
    left = spark.range(5000).select((F.col("id") * 7).alias("k"))
    rows = lambda df: sorted(map(tuple, df.collect()))
    right = left.where("k % 500 <> 0").unionByName(table("k bigint", (-1,), (-2,), (None,)))
    assert rows(reconcile_unique(left, right, "k")) == rows(reconcile(left, right, "k"))
    assert rows(reconcile_unique(left, left, "k")) == [(7 * k, "matched") for k in range(5000)]
    assert rows(reconcile_unique(left.limit(0), right, "k")) == rows(reconcile(left.limit(0), right, "k"))
    # Between equal sets no bucket is open: the plan's exchange has nothing to move.
    physical = plan_of(reconcile_unique(left, left, "k")).split("Physical Plan")[1]
    assert "Exchange" not in physical


def test_buckets_are_found_by_halving(spark):
    keys = spark.range(5000).select(F.when(F.col("id") % 50 > 0, F.col("id") * 3 % 7919).alias("k"))
    buckets = RangeBuckets(keys, ["k"], 20)
    splits = sorted(s[0] for s in buckets._splits)
    assert len(splits) > 200
    for n in (1, 2, 3, 64, 127, len(splits)):  # any number of splits
        buckets._splits = [(x,) for x in splits[:n]]
        rows = keys.withColumn("b", buckets.number())
        assert all(r.b == (0 if r.k is None else bisect.bisect_right(splits[:n], r.k)) for r in rows.collect())
    # One look-up a step, instead of filters over blocks of splits.
    plan = rows._jdf.queryExecution().analyzed().toString()
    assert "reduce(" in plan and "filter(" not in plan


def test_median_computes_the_folded_rows_once(spark):
    rows = spark.range(2000).select((F.col("id") % 7).cast("string").alias("k"), (F.col("id") * 37 % 101).cast("double").alias("v"))
    kept = spark.range(2000).select((F.col("id") % 5).cast("string").alias("k"))
    found = median_per_key(rows.join(kept.distinct(), "k"), "k", "v", "m", values_per_bucket=10)
    plan = found._jdf.queryExecution().executedPlan()
    found.collect()
    assert "ReusedExchange" in plan.toString()
