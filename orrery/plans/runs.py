"""Table runs: read from the catalog, build, check, publish, log."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from functools import partial, reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery import fixed
from orrery.operators.quality_log import (
    generate_dq_summary,
    log_invalid_rows,
    log_invalid_summary,
    log_row_count,
)
from orrery.operators.rules import halves
from orrery.plans import checks, dims, facts, silver
from orrery.sources.files import read_raw_order_payments
from orrery.sources.tables import publish_table, read_table, write_path

SILVER, GOLD = fixed.SILVER_TABLES, fixed.GOLD_TABLES


# --------------------------------------------------------------------- silver
def run_silver(
    spark: SparkSession,
    dataset: str,
    raw: DataFrame,
    clean: Callable[[DataFrame], DataFrame],
    fmt: str = "parquet",
) -> DataFrame:
    """Clean one raw table into its Silver table; quarantine and log what is rejected.

    Rows that break a rule are kept out of Silver, so that Gold is built on accepted
    rows only: most tables are split by their rules, payments and reviews drop such
    rows as they are cleaned.  The rejected rows go to a quarantine table
    with their reasons, and the logs are written from there.  Where both halves come from
    the rules, the judged rows are written once and both are read from that.

    The counts are plain counts, which a column store answers from its metadata.
    Observed metrics would be free, but they count a partition twice when a lost
    executor's work is repeated, and these numbers decide whether a load passes.
    """
    accepted = clean(silver.well_formed(raw))
    if dataset in silver.SHAPES:
        judged, both = silver.judged(dataset, raw), f"{SILVER[dataset]}__judged"
        if dataset in SPLIT_BY_RULES:
            judged = publish_table(judged, both, fmt=fmt)
            accepted, _ = halves(judged)
        _, rejected = halves(judged)
        held = publish_table(rejected, quarantine_name(dataset), fmt=fmt)
        log_invalid_rows(dataset, held.select(F.inline("broken_rules")), fmt=fmt)
        log_invalid_summary(spark, dataset, quarantine_name(dataset), fmt=fmt)
    table = publish_table(accepted, SILVER[dataset], fmt=fmt)
    if dataset in SPLIT_BY_RULES:
        spark.sql(f"DROP TABLE IF EXISTS `{both}`")
    log_row_count(spark, dataset, fixed.STAGE_BEFORE, raw.count(), fmt=fmt)
    log_row_count(spark, dataset, fixed.STAGE_AFTER, table.count(), fmt=fmt)
    return table


# Tables without a survivor rule: the quarantine rules alone decide what reaches Silver.
SPLIT_BY_RULES = ("customers", "sellers", "orders", "order_items", "products")


def quarantine_name(dataset: str) -> str:
    return f"quarantine_{dataset}"


def clean_order_payments_path(
    spark: SparkSession,
    input_path: str,
    output_path: str | None = None,
    output_format: str = "parquet",
    drop_not_defined: bool = False,
) -> DataFrame:
    """Read raw payments, clean them, and write them when a path is given.

    The written data are read back for the result: the cleaning runs once.
    """
    raw = read_raw_order_payments(spark, input_path)
    cleaned = silver.clean_order_payments(raw, drop_not_defined)
    if output_path is None:
        return cleaned
    write_path(cleaned, output_path, output_format)
    return spark.read.format(output_format).load(output_path)


CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "customers": silver.clean_customers,
    "sellers": silver.clean_sellers,
    "orders": silver.clean_orders,
    "order_items": silver.clean_order_items,
    "order_payments": silver.clean_order_payments,
    "products": silver.clean_products,
    "order_reviews": silver.clean_reviews,
    "product_category": silver.clean_category_translation,
}


def run_all_silver(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    fmt: str = "parquet",
    cleaners: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
) -> dict[str, DataFrame]:
    """Every raw table through `run_silver`; `cleaners` replace those of `CLEANERS`."""
    clean = {**CLEANERS, **(cleaners or {})}
    return {name: run_silver(spark, name, df, clean[name], fmt) for name, df in raw.items()}


# ----------------------------------------------------------------------- gold
def run_dim_date(
    spark: SparkSession,
    fmt: str = "parquet",
    start_date: str = fixed.CALENDAR_START,
    end_date: str = fixed.CALENDAR_END,
    study_year: int = fixed.STUDY_YEAR,
) -> DataFrame:
    built = dims.build_dim_date(spark, start_date, end_date, study_year)
    check = partial(checks.validate_dim_date_gold, study_year=study_year)
    return publish_table(built, GOLD["dim_date"], check, fmt)


def key_table(name: str, stable_keys: bool) -> str | None:
    """Where a dimension's keys are kept, if they are to outlive a load."""
    return f"{GOLD[name]}__keys" if stable_keys else None


def run_dim_customer(
    spark: SparkSession, fmt: str = "parquet", stable_keys: bool = False
) -> DataFrame:
    built = dims.build_dim_customer(
        read_table(spark, SILVER["customers"]),
        read_table(spark, SILVER["orders"]),
        key_table=key_table("dim_customer", stable_keys),
    )
    return publish_table(built, GOLD["dim_customer"], fmt=fmt)


def run_dim_product(
    spark: SparkSession,
    fmt: str = "parquet",
    study_year: int = fixed.STUDY_YEAR,
    stable_keys: bool = False,
) -> DataFrame:
    built = dims.build_dim_product_gold(
        read_table(spark, SILVER["products"]),
        read_table(spark, SILVER["product_category"]),
        read_table(spark, SILVER["order_items"]),
        read_table(spark, SILVER["orders"]),
        study_year,
        key_table("dim_product", stable_keys),
    )
    return publish_table(built, GOLD["dim_product"], fmt=fmt)


def run_dim_seller(
    spark: SparkSession, fmt: str = "parquet", stable_keys: bool = False
) -> DataFrame:
    sellers = read_table(spark, SILVER["sellers"])
    built = dims.clean_dim_seller_gold(sellers, key_table("dim_seller", stable_keys))
    return publish_table(built, GOLD["dim_seller"], checks.validate_dim_seller_gold, fmt)


def run_fact_order(spark: SparkSession, fmt: str = "parquet") -> DataFrame:
    built = facts.build_fact_orders_gold(
        read_table(spark, SILVER["orders"]),
        read_table(spark, SILVER["order_items"]),
        read_table(spark, SILVER["order_payments"]),
        read_table(spark, SILVER["customers"]),
        read_table(spark, GOLD["dim_customer"]),
        read_table(spark, GOLD["dim_date"]),
    )
    return publish_table(built, GOLD["fact_order"], fmt=fmt)


def _no_missing_keys(message: str, *keys: str) -> Callable[[DataFrame], None]:
    """Check of a written fact: every key column is filled (a narrow scan)."""

    def check(written: DataFrame) -> None:
        missing = F.lit(False)
        for key in keys:
            missing = missing | F.col(key).isNull()
        if not written.where(missing).isEmpty():
            raise ValueError(message)

    return check


def _without_orphans(
    built: DataFrame,
    name: str,
    keys: Sequence[str],
    fmt: str,
    check: Callable[[DataFrame], object] | None = None,
) -> DataFrame:
    """The fact without rows whose keys are unknown, which go to a quarantine table.

    The joins run once: both halves are read from what was written.
    """
    spark = built.sparkSession
    unknown = reduce(or_, (F.col(k).isNull() for k in keys))
    whole = publish_table(built, f"{name}__all", fmt=fmt)
    publish_table(whole.where(unknown), quarantine_name(name), fmt=fmt)
    fact = publish_table(whole.where(~unknown), name, check, fmt)
    spark.sql(f"DROP TABLE IF EXISTS `{name}__all`")
    return fact


def run_fact_order_item(
    spark: SparkSession, fmt: str = "parquet", orphans: str = facts.RAISE
) -> DataFrame:
    """The joins run once: orphans are looked for in the written staging table.

    With `orphans="drop"` they go to a quarantine table instead of stopping the run.
    """
    built = facts.build_fact_order_item_gold(
        read_table(spark, SILVER["order_items"]),
        read_table(spark, GOLD["fact_order"]),
        read_table(spark, GOLD["dim_product"]),
        read_table(spark, GOLD["dim_seller"]),
        orphans=facts.KEEP,
    )
    if orphans == facts.DROP:
        return _without_orphans(built, GOLD["fact_order_item"], facts.ITEM_KEYS, fmt)
    check = _no_missing_keys(
        "Order items without a known order, customer, product or seller", *facts.ITEM_KEYS
    )
    return publish_table(built, GOLD["fact_order_item"], check, fmt)


def run_fact_review(
    spark: SparkSession, fmt: str = "parquet", orphans: str = facts.RAISE
) -> DataFrame:
    built = facts.build_fact_review_gold(
        read_table(spark, SILVER["order_reviews"]),
        read_table(spark, GOLD["fact_order"]),
        orphans=facts.KEEP,
        unique_key=None,
    )
    if orphans == facts.DROP:
        return _without_orphans(
            built, GOLD["fact_review"], ["order_date_key"], fmt, checks.validate_fact_review_gold
        )
    return publish_table(built, GOLD["fact_review"], checks.validate_fact_review_gold, fmt)


#: The tables that each Gold table is made from.
MADE_FROM = {
    "dim_date": (),
    "dim_customer": ("customers", "orders"),
    "dim_product": ("products", "product_category", "order_items", "orders"),
    "dim_seller": ("sellers",),
    "fact_order": ("orders", "order_items", "order_payments", "customers", "dim_customer", "dim_date"),
    "fact_order_item": ("order_items", "fact_order", "dim_product", "dim_seller"),
    "fact_review": ("order_reviews", "fact_order"),
}


#: Tables whose check can stop a run, whatever is done with orphans.
CHECKED = ("dim_date", "dim_seller", "fact_review")


def behind(dataset: str) -> set[str]:
    """A table and all that it is made from, directly or not."""
    return {dataset}.union(*map(behind, MADE_FROM.get(dataset, ())))


def run_all_gold(
    spark: SparkSession,
    fmt: str = "parquet",
    orphans: str = facts.RAISE,
    calendar: tuple[str, str] = (fixed.CALENDAR_START, fixed.CALENDAR_END),
    study_year: int = fixed.STUDY_YEAR,
    stable_keys: bool = False,
    only: Collection[str] | None = None,
) -> dict[str, DataFrame]:
    """All Gold tables, or those in `only`, dimensions before the facts that need them.

    With `stable_keys` customers, products and sellers keep their keys from load to load.
    """
    steps = {
        "dim_date": partial(run_dim_date, spark, fmt, *calendar, study_year),
        "dim_customer": partial(run_dim_customer, spark, fmt, stable_keys),
        "dim_product": partial(run_dim_product, spark, fmt, study_year, stable_keys),
        "dim_seller": partial(run_dim_seller, spark, fmt, stable_keys),
        "fact_order": partial(run_fact_order, spark, fmt),
        "fact_order_item": partial(run_fact_order_item, spark, fmt, orphans),
        "fact_review": partial(run_fact_review, spark, fmt, orphans),
    }
    return {name: run() for name, run in steps.items() if only is None or name in only}


def run_summary(spark: SparkSession, fmt: str = "parquet") -> DataFrame:
    return generate_dq_summary(spark, fmt=fmt)
