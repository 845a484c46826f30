"""Every registered query against its SQL counterpart, on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
import oracle
from orrery import fixed
from orrery.operators.rules import RuleViolation
from orrery.plans import runs
from orrery.queries import _database, all_queries
from orrery.sources.trade import TABLES

SF = "/root/testdata/sf0.001"
QUERIES, STATEMENTS = all_queries(), oracle.statements()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def comparable(rows, columns) -> list[tuple]:
    def plain(value):
        if isinstance(value, float) and math.isnan(value):
            return "NaN"
        return "NULL" if value is None else str(value)

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def test_registry():
    assert set(STATEMENTS) == set(QUERIES)
    assert QUERIES.keys() <= entry_module.queries().keys()
    assert STATEMENTS.keys() <= entry_module.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    answer = duck.execute(STATEMENTS[name])
    columns = [d[0] for d in answer.description]
    assert sorted(df.columns) == sorted(columns)
    assert comparable(df.collect(), df.columns) == comparable(answer.fetchall(), columns)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_payment_files_grow_in_number(spark, tmp_path):
    """With more partitions the payments lie in more files; no file holds all first payments."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        df = QUERIES["payments_from_csv"](spark, SF)
        assert len(df.inputFiles()) > 8
        want = QUERIES["clean_payments"](spark, SF)
        assert comparable(df.collect(), df.columns) == comparable(want.collect(), want.columns)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["rule_counts_fact_order_item", "rule_counts_fact_order_item_spoiled"])
def test_rules_of_the_item_fact_read_it_written(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "price_vs_baseline_pct" in plan and "baseline_price_med" not in plan


def test_a_check_stops_any_run(spark, tmp_path):
    for name in TABLES:
        rows = spark.read.parquet(f"{SF}/{name}.parquet")
        (rows.union(rows) if name == "supplier" else rows).write.parquet(str(tmp_path / f"{name}.parquet"))
    for name in ("published_fact_review", "published_summary"):
        with pytest.raises(RuleViolation, match="seller_id.repeated"):
            QUERIES[name](spark, str(tmp_path))


def test_published_tables_take_the_steps_that_they_are_made_from(spark, tmp_path):
    import shutil

    folder = str(tmp_path / "sf")
    shutil.copytree(SF, folder)
    database = _database(spark, folder, "run")
    tables = lambda: {t.name for t in spark.catalog.listTables(database)}
    logs = QUERIES["published_invalid_counts"](spark, folder).collect()
    assert len(logs) == 7 and not {"gold_dim_product", "gold_fact_order_item"} & tables()
    assert {fixed.GOLD_TABLES[name] for name in runs.CHECKED} <= tables()
    first = QUERIES["published_fact_review"](spark, folder).count()
    assert first > 0 and not {"gold_dim_product", "gold_fact_order_item"} & tables()
    assert QUERIES["published_fact_order_item"](spark, folder).count() > 0
    assert QUERIES["published_invalid_counts"](spark, folder).count() == len(logs)
    assert QUERIES["published_fact_review"](spark, folder).count() == first
    assert not any(t.endswith("__judged") for t in tables())
