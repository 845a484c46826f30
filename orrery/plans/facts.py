"""Fact builders: clean, resolve keys, measure."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery import fixed
from orrery.functions import casting, measures, text
from orrery.operators.headers import require_columns, standard_headers
from orrery.operators.rules import RuleSet, UniqueRule, must
from orrery.operators.survivors import distinct_by_key, distinct_rows, first_per_key
from orrery.plans.dims import customer_people

RAISE, KEEP, DROP = "raise", "keep", "drop"


def _settle_orphans(
    df: DataFrame, keys: Sequence[str], orphans: str, message: str
) -> DataFrame:
    """What to do with rows whose foreign keys did not resolve.

    raise  stop with a ValueError; one probe that reads until the first orphan
    keep   leave the NULL keys in place
    drop   leave the rows out; `orphan_*` returns exactly these rows
    """
    unresolved = _any_null(keys)
    if orphans == DROP:
        return df.where(~unresolved)
    if orphans == RAISE and not df.where(unresolved).isEmpty():
        raise ValueError(message)
    return df


def _any_null(keys: Sequence[str]) -> Column:
    unresolved = F.col(keys[0]).isNull()
    for key in keys[1:]:
        unresolved = unresolved | F.col(key).isNull()
    return unresolved


# --------------------------------------------------------------------- orders
def clean_fact_orders_gold(df: DataFrame) -> DataFrame:
    """Orders with a customer and a purchase that is not in the future."""
    df = require_columns(standard_headers(df), fixed.ORDER_COLUMNS, "orders")
    shaped = df.select(*fixed.ORDER_COLUMNS).withColumns(
        {
            "order_status": text.lowered("order_status"),
            **{c: casting.to_time(c) for c in fixed.ORDER_TIMES},
        }
    )
    return distinct_rows(
        shaped.where(
            F.col("order_id").isNotNull()
            & F.col("customer_id").isNotNull()
            & (F.col("order_purchase_timestamp") <= F.current_timestamp())
        )
    )


def _clean_order_rows(orders: DataFrame) -> DataFrame:
    """The columns of the order fact that come from the order itself."""
    return clean_fact_orders_gold(orders).select(
        "order_id",
        "customer_id",
        F.to_date("order_purchase_timestamp").alias("date"),
        measures.days_late(
            "order_delivered_customer_date", "order_estimated_delivery_date"
        ).alias("delivery_delay_days"),
    )


def _with_order_keys(
    rows: DataFrame,
    customers: DataFrame,
    dim_customer: DataFrame,
    dim_date: DataFrame,
    customer_ids_unique: bool,
) -> DataFrame:
    people = customers.select("customer_id", "customer_unique_id")
    if not customer_ids_unique:
        people = customer_people(people)
    persons = people.join(
        dim_customer.select("customer_unique_id", "customer_key", "first_order_date"),
        "customer_unique_id",
    ).select("customer_id", "customer_key", "first_order_date")
    is_new = measures.is_true(F.col("date") == F.col("first_order_date"))
    return (
        rows.join(persons, "customer_id", "left")
        .join(dim_date.select("date", "date_key"), "date", "left")
        .withColumn("is_new_at_order", is_new)
    )


def build_order_keys(
    orders: DataFrame,
    customers: DataFrame,
    dim_customer: DataFrame,
    dim_date: DataFrame,
    customer_ids_unique: bool = False,
) -> DataFrame:
    """order_id, date_key, customer_key: all that the other facts need of an order.

    The item and review facts take this in place of the order fact where the latter
    has not been written yet; items and payments are not touched for it.
    """
    keyed = _with_order_keys(
        _clean_order_rows(orders), customers, dim_customer, dim_date, customer_ids_unique
    )
    return keyed.select("order_id", "date_key", "customer_key")


def build_fact_orders_gold(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    customers: DataFrame,
    dim_customer: DataFrame,
    dim_date: DataFrame,
    customer_ids_unique: bool = False,
) -> DataFrame:
    """One row per order: keys, value, item count, payments, delay, new-customer flag.

    Items and payments are folded per order before they are joined, and the three
    order_id-keyed frames share one partitioning.
    """
    per_item_order = items.groupBy("order_id").agg(
        F.sum(casting.to_money("price")).cast("double").alias("order_value"),
        F.count(F.lit(1)).alias("item_count"),
    )
    per_payment_order = payments.groupBy("order_id").agg(
        F.sum(casting.to_money("payment_value")).cast("double").alias("payment_value_total")
    )
    measured = (
        _clean_order_rows(orders)
        .join(per_item_order, "order_id", "left")
        .join(per_payment_order, "order_id", "left")
        .fillna({"order_value": 0.0, "item_count": 0, "payment_value_total": 0.0})
    )
    return _with_order_keys(
        measured, customers, dim_customer, dim_date, customer_ids_unique
    ).select(*fixed.FACT_ORDER_COLUMNS)


# ---------------------------------------------------------------- order items
def item_acceptance(reject_blank: bool = False) -> RuleSet:
    """Row rules of the item fact; blank ids count as present unless told otherwise."""
    col = F.col
    ids = ["order_id", "product_id", "seller_id"]
    amounts = {"price": col("price") > 0, "freight_value": col("freight_value") >= 0}
    return RuleSet(
        "fact_order_item",
        fixed.ITEM_COLUMNS,
        [
            *(must(f"{c} is present", c,
                   col(c) != "" if reject_blank else col(c).isNotNull()) for c in ids),
            must("item number is positive", "order_item_id", col("order_item_id") > 0),
            must("shipping limit is present", "shipping_limit_date",
                 col("shipping_limit_date").isNotNull()),
            *(must(f"{c} is an accepted amount", c, ok & measures.below_infinity(c))
              for c, ok in amounts.items()),
        ],
    )


def _shape_items(df: DataFrame) -> DataFrame:
    df = require_columns(standard_headers(df), fixed.ITEM_COLUMNS, "order_items")
    return df.withColumns(
        {
            **{c: text.stripped(c) for c in ("order_id", "product_id", "seller_id")},
            "order_item_id": casting.to_int("order_item_id"),
            "shipping_limit_date": casting.to_time("shipping_limit_date"),
            "price": casting.to_double("price"),
            "freight_value": casting.to_double("freight_value"),
        }
    )


def clean_fact_order_item(df: DataFrame, reject_blank: bool = False) -> DataFrame:
    """Accepted items; rows equal in every column of the input collapse."""
    accepted = item_acceptance(reject_blank).accept(_shape_items(df))
    return distinct_rows(accepted).select(*fixed.ITEM_COLUMNS)


ITEM_KEYS = ("date_key", "customer_key", "product_key", "seller_key")


def resolve_item_keys(
    items: DataFrame,
    fact_orders: DataFrame,
    dim_product: DataFrame,
    dim_seller: DataFrame,
    fact_orders_unique: bool = False,
) -> DataFrame:
    """Clean items with the keys of order, product and seller; NULL where unknown.

    Plain left joins: Spark broadcasts a dimension that proves small and splits the
    partitions of a hot order, product or seller otherwise.  Items are cleared of copies
    and joined to their orders in one exchange.
    """
    orders = fact_orders.select("order_id", "date_key", "customer_key")
    if not fact_orders_unique:
        orders = first_per_key(orders, ["order_id"])
    shaped = _shape_items(items)
    parts = distinct_by_key(
        item_acceptance().accept(shaped), "order_id", size_from=shaped.select("order_id")
    )
    ordered = (p.select(*fixed.ITEM_COLUMNS).join(orders, "order_id", "left") for p in parts)
    return (
        reduce(DataFrame.unionByName, ordered)
        # Sellers first: they are few, and their keys are short in the next exchange.
        .join(dim_seller.select("seller_id", "seller_key"), "seller_id", "left")
        .join(dim_product.select("product_id", "product_key", "baseline_price_med"),
              "product_id", "left")
    )


def orphan_items(
    items: DataFrame, fact_orders: DataFrame, dim_product: DataFrame, dim_seller: DataFrame,
    fact_orders_unique: bool = False,
) -> DataFrame:
    """Item rows with an unresolved key, with the keys that did resolve."""
    resolved = resolve_item_keys(items, fact_orders, dim_product, dim_seller, fact_orders_unique)
    return resolved.where(_any_null(ITEM_KEYS)).select(
        "order_id", "order_item_id", "product_id", "seller_id", *ITEM_KEYS
    )


def build_fact_order_item_gold(
    items: DataFrame,
    fact_orders: DataFrame,
    dim_product: DataFrame,
    dim_seller: DataFrame,
    orphans: str = RAISE,
    fact_orders_unique: bool = False,
) -> DataFrame:
    """One row per order item with its four keys and the distance to the baseline."""
    resolved = resolve_item_keys(items, fact_orders, dim_product, dim_seller, fact_orders_unique)
    settled = _settle_orphans(
        resolved, ITEM_KEYS, orphans,
        "Order items without a known order, customer, product or seller",
    )
    below = measures.percent_below("price", "baseline_price_med")
    return settled.withColumn("price_vs_baseline_pct", below).select(*fixed.FACT_ITEM_COLUMNS)


clean_fact_order_item_gold = clean_fact_order_item
build_fact_order_items_gold = build_fact_order_item_gold


# -------------------------------------------------------------------- reviews
def clean_fact_review_gold(df: DataFrame) -> DataFrame:
    """Typed reviews with ids, a score, and an answer not before the creation.

    Only a comment that is empty as it stands becomes NULL here; one made of spaces
    is stripped to an empty text.
    """
    df = require_columns(standard_headers(df), fixed.REVIEW_COLUMNS, "order_reviews")
    comments = ("review_comment_title", "review_comment_message")
    shaped = df.withColumns(
        {
            **{c: text.stripped(c) for c in ("review_id", "order_id")},
            **{c: F.trim(F.nullif(F.col(c), F.lit(""))) for c in comments},
            "review_score": casting.to_int("review_score"),
            "review_creation_date": casting.to_time("review_creation_date"),
            "review_answer_timestamp": casting.to_time("review_answer_timestamp"),
        }
    )
    accepted = shaped.where(
        F.col("review_id").isNotNull()
        & F.col("order_id").isNotNull()
        & F.col("review_score").between(*fixed.SCORE_RANGE)
        & (F.col("review_answer_timestamp") >= F.col("review_creation_date"))
    )
    return distinct_rows(accepted).select(*fixed.REVIEW_COLUMNS)


def _review_rows(reviews: DataFrame) -> DataFrame:
    needed = ("review_id", "order_id", "review_score")
    shaped = require_columns(reviews, needed, "order_reviews").select(
        text.stripped("review_id").alias("review_id"),
        text.stripped("order_id").alias("order_id"),
        casting.to_int("review_score").alias("review_score"),
    )
    return distinct_rows(
        shaped.where(
            (F.col("review_id") != "")
            & (F.col("order_id") != "")
            & F.col("review_score").between(*fixed.SCORE_RANGE)
        )
    )


def _review_keys(
    reviews: DataFrame, fact_orders: DataFrame, fact_orders_unique: bool = False
) -> DataFrame:
    orders = fact_orders.select("order_id", F.col("date_key").alias("order_date_key"))
    if not fact_orders_unique:
        orders = first_per_key(orders, ["order_id"])
    return _review_rows(reviews).join(orders, "order_id", "left")


def orphan_reviews(
    reviews: DataFrame, fact_orders: DataFrame, fact_orders_unique: bool = False
) -> DataFrame:
    """Review rows whose order is not in the order fact."""
    keyed = _review_keys(reviews, fact_orders, fact_orders_unique)
    return keyed.where("order_date_key IS NULL").select("review_id", "order_id", "review_score")


def build_fact_review_gold(
    reviews: DataFrame,
    fact_orders: DataFrame,
    orphans: str = RAISE,
    unique_key: Sequence[str] | None = ("review_id",),
    fact_orders_unique: bool = False,
) -> DataFrame:
    """One row per review with the date key of its order.

    `unique_key` names what has to be unique and is checked before the join; pass
    ("review_id", "order_id") where one review may cover several orders, or None when
    the caller has checked it already.
    """
    if unique_key:
        rule = UniqueRule("unique review", tuple(unique_key))
        if not rule.repeated(_review_rows(reviews)).isEmpty():
            raise ValueError(f"{', '.join(unique_key)} must be unique in the review fact")
    settled = _settle_orphans(
        _review_keys(reviews, fact_orders, fact_orders_unique), ["order_date_key"], orphans,
        "Reviews without a known order",
    )
    return settled.select(*fixed.FACT_REVIEW_COLUMNS)
