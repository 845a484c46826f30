"""Cleaning of the raw tables, on rows made for one rule at a time."""

import pytest
from conftest import strings, values

from orrery import fixed
from orrery.plans import silver


def rows_of(table, columns, base, *changes):
    """Text rows: `base` with one change each."""
    return table(strings(columns), *(tuple({**base, **c}[k] for k in columns) for c in changes))


CUSTOMER = dict(zip(fixed.CUSTOMER_COLUMNS, ("cu", "person", "45000", "  ILHABELA ", " ba ")))
SELLER = dict(zip(fixed.SELLER_COLUMNS, ("shop", "77001", "Palmas ", "to")))


@pytest.mark.parametrize(
    "columns, base, clean, prefix",
    [(fixed.CUSTOMER_COLUMNS, CUSTOMER, silver.clean_customers, "customer"), (fixed.SELLER_COLUMNS, SELLER, silver.clean_sellers, "seller")],
)
def test_parties(table, columns, base, clean, prefix):
    ident, zip_code = f"{prefix}_id", f"{prefix}_zip_code_prefix"
    faults = [{ident: None}, {f"{prefix}_city": None}, {f"{prefix}_state": None}, {zip_code: "0999"}, {zip_code: "100000"}, {zip_code: "4500x"}]
    raw = rows_of(table, columns, base, {}, {ident: "low", zip_code: "1000"}, {ident: "high", zip_code: "99999"}, *faults)
    kept = clean(raw)
    assert sorted(values(kept, ident)) == sorted([base[ident], "low", "high"])
    row = kept.where(f"{ident} = '{base[ident]}'").first()
    assert row[f"{prefix}_city"] == base[f"{prefix}_city"].strip().lower()
    assert row[f"{prefix}_state"] == base[f"{prefix}_state"].strip().upper() and row[zip_code] == int(base[zip_code])


def test_every_table_has_a_quarantine(table):
    raw = rows_of(table, fixed.SELLER_COLUMNS, SELLER, {}, {"seller_id": "s2", "seller_state": "q"}, {"seller_id": None})
    accepted, rejected = silver.quarantine("sellers", raw)
    assert values(accepted, "seller_id") == ["shop"] and rejected.count() == 2
    items = dict(zip(fixed.ITEM_COLUMNS, ("ord", "1", "pr", "se", "2018-03-01 00:00:00", "5", "1")))
    raw = rows_of(table, fixed.ITEM_COLUMNS, items, {}, {"order_item_id": "2"}, {"order_item_id": "2"}, {"order_item_id": "3", "price": "0"})
    accepted, rejected = silver.quarantine("order_items", raw)
    assert accepted.count() == 1 and rejected.count() == 3
    assert set(silver.SHAPES) == {"customers", "sellers", "orders", "order_items", "order_payments", "products", "order_reviews"}
    tally = silver.tally("order_items", raw).first()
    assert tuple(tally) == (4, 4, 3)


def test_orders_and_items_keep_every_row(table):
    order = dict.fromkeys(fixed.ORDER_COLUMNS) | {"order_id": "ord", "order_status": " Shipped", "order_purchase_timestamp": "2018-03-01 08:00:00", "order_approved_at": "soon"}
    clean = silver.clean_orders(rows_of(table, fixed.ORDER_COLUMNS, order, {}, {"order_id": None}))
    row = clean.where("order_id = 'ord'").first()
    assert clean.count() == 2 and row["order_status"] == "shipped" and row["order_approved_at"] is None
    assert {dict(clean.dtypes)[c] for c in fixed.ORDER_TIMES} == {"timestamp"}
    item = dict(zip(fixed.ITEM_COLUMNS, ("  ord", "2", "pr ", " se ", "not a time", "3.5", "free")))
    row = silver.clean_order_items(rows_of(table, fixed.ITEM_COLUMNS, item, {})).first()
    assert tuple(row[c] for c in fixed.ITEM_COLUMNS) == ("ord", 2, "pr", "se", None, 3.5, None)


# -------------------------------------------------------------------- payments
PAYMENT = dict(zip(fixed.PAYMENT_COLUMNS, ("5" * 32, "3", " Debit_Card ", "6", "44.1")))
BAD_PAYMENTS = [
    {"order_id": None}, {"order_id": "5" * 33}, {"payment_sequential": "0"}, {"payment_sequential": "third"},
    {"payment_type": "shells"}, {"payment_installments": "-2"}, {"payment_value": "-0.1"}, {"payment_value": "much"},
]


def clean_payments(table, *changes, **options):
    raw = rows_of(table, fixed.PAYMENT_COLUMNS, PAYMENT, *changes)
    return silver.clean_order_payments(raw, **{"order_by": ["payment_value"], **options})


def test_payments_without_faults_survive(table):
    assert [tuple(r) for r in clean_payments(table, {}, *BAD_PAYMENTS).collect()] == [("5" * 32, 3, "debit_card", 6, 44.1)]


def test_payments_first_in_the_named_order_survives_and_cards_have_an_installment(table):
    kept = clean_payments(
        table, {"payment_value": "2", "payment_type": "voucher"}, {"payment_value": "1", "payment_type": "CREDIT_CARD", "payment_installments": "0"},
        {"payment_value": "0", "payment_type": "shells"}, {"payment_sequential": "4", "payment_type": "boleto", "payment_installments": "0"},
    )
    assert {(r[1], r[2], r[3], r[4]) for r in kept.collect()} == {(3, "credit_card", 1, 1.0), (4, "boleto", 0, 44.1)}


def test_payments_options_and_headers(table):
    changes = ({"payment_type": "not_defined"}, {"order_id": "6" * 32})
    assert clean_payments(table, *changes).count() == 2
    assert clean_payments(table, *changes, drop_not_defined=True).count() == 1
    raw = rows_of(table, fixed.PAYMENT_COLUMNS, PAYMENT, {})
    odd = raw.toDF(*(f" {c.title()}" for c in raw.columns))
    clean = silver.clean_order_payments(odd, order_by=[" Payment_Value"])
    assert dict(clean.dtypes) == fixed.PAYMENT_TYPES_BY_COLUMN and clean.count() == 1
    with pytest.raises(ValueError, match="order_payments: missing required column.s.: .'payment_type'."):
        silver.clean_order_payments(raw.drop("payment_type"), order_by=["payment_value"])


def test_payment_totals_are_decimals(table):
    kept = clean_payments(table, {"payment_value": "0.1"}, {"payment_sequential": "4", "payment_value": "0.2"}, {"order_id": "6" * 32})
    totals = silver.aggregate_order_payment_totals(kept)
    assert {r[0]: (r[1], str(r[2])) for r in totals.collect()} == {"5" * 32: (2, "0.30"), "6" * 32: (1, "44.10")}


# -------------------------------------------------------------------- products
SOURCE = [{v: k for k, v in fixed.PRODUCT_RENAMES.items()}.get(c, c) for c in fixed.PRODUCT_COLUMNS]
PRODUCT = dict(zip(SOURCE, ("9" * 32, "Redes--de_Dormir ", *"7654321")))


def test_products(table):
    weight = SOURCE[fixed.PRODUCT_COLUMNS.index("product_weight_g")]
    raw = rows_of(table, SOURCE, PRODUCT, {}, {}, {weight: "heavy"}, {"product_id": " ", "product_category_name": ""})
    clean = silver.clean_products(raw.withColumnRenamed("product_id", "﻿product_id"))
    assert tuple(clean.columns) == fixed.PRODUCT_COLUMNS
    assert clean.count() == 3  # an exact copy goes, a conflicting one stays
    assert set(values(clean, "product_category_name")) == {"redes de dormir", None}
    assert clean.where("product_weight_g IS NULL AND product_id IS NOT NULL").count() == 1
    with pytest.raises(ValueError, match="products: missing required column"):
        silver.clean_products(raw.drop(weight))


# --------------------------------------------------------------------- reviews
REVIEW = dict(zip(fixed.REVIEW_COLUMNS, ("rev", "ord", "2", "Creaks", "when it rains", "2018-03-05 00:00:00", "2018-03-06 12:00:00")))


def shaped(table, *changes):
    return silver.standardise_reviews(rows_of(table, fixed.REVIEW_COLUMNS, REVIEW, *changes))


def test_reviews_are_standardised(table):
    df = shaped(table, {"review_comment_title": "\t ", "review_comment_message": " when\n\r\nit rains", "review_score": "two"})
    row = df.first()
    assert (row["review_comment_message"], row["review_score"]) == ("when it rains", None)
    assert dict(df.dtypes)["review_answer_timestamp"] == "timestamp"


def test_review_stages_are_those_of_the_cleaning(table):
    changes = [{}, {"review_id": ""}, {"review_score": "0"}, {"review_id": "late", "review_answer_timestamp": "2018-03-04 00:00:00"}, {"review_creation_date": "?"}]
    df = shaped(table, *changes)
    assert silver.drop_missing_key_fields(df).count() == 3
    assert silver.keep_valid_scores(df).count() == 4
    assert silver.keep_valid_dates(df).count() == 3
    staged = silver.keep_valid_dates(silver.keep_valid_scores(silver.drop_missing_key_fields(df)))
    assert [tuple(r) for r in staged.collect()] == [tuple(r) for r in silver.review_acceptance().accept(df).collect()]


def test_the_newest_review_survives(table):
    times = [f"2018-03-{d:02d} 09:00:00" for d in (7, 9, 8)]
    raw = rows_of(
        table, fixed.REVIEW_COLUMNS, REVIEW, *({"review_answer_timestamp": t} for t in times),
        {"review_id": "other", "review_answer_timestamp": times[0]}, {"order_id": "ord2"},
    )
    assert silver.clean_reviews(raw).count() == 3
    latest = silver.clean_reviews(raw, one_review_per_order=True)
    assert {(r["order_id"], r["review_id"], r["review_answer_timestamp"].day) for r in latest.collect()} == {("ord", "rev", 9), ("ord2", "rev", 6)}


def test_going_straight_to_the_newest_per_order_equals_both_steps(table):
    changes = [
        {"review_id": f"r{i % 5}", "order_id": f"o{i % 4}", "review_score": str(1 + i % 3), "review_comment_title": f"t{i % 2}",
         "review_answer_timestamp": f"2018-03-{10 + i % 3} 00:00:00"} for i in range(70)
    ]
    df = shaped(table, *changes)
    steps = silver.latest_review_per_order(silver.remove_duplicates(df))
    assert sorted(map(str, steps.collect())) == sorted(map(str, silver.latest_review_per_order(df).collect()))


def test_missing_comments_are_filled_and_flagged(table):
    row = silver.clean_reviews(rows_of(table, fixed.REVIEW_COLUMNS, REVIEW, {"review_comment_title": None})).first()
    assert (row["review_comment_title"], row["has_comment_title"]) == (fixed.NO_TITLE, False)
    assert (row["review_comment_message"], row["has_comment_message"]) == ("when it rains", True)


# ------------------------------------------------------------------ categories
def test_category_translation_fills_gaps_with_the_patch(table):
    patched = dict(fixed.CATEGORY_PATCH)
    known = next(iter(patched))
    raw = table(strings(fixed.CATEGORY_COLUMNS), ("Redes_-De__Dormir", " hammocks_and SWINGS"), ("redes de dormir", "Hammocks_and Swings"), (None, "lost"), (known.upper(), "own name"))
    found = {r[0]: r[1] for r in silver.clean_category_translation(raw).collect()}
    assert found == {**patched, "redes de dormir": "Hammocks_and Swings", known: "Own Name"}


def test_category_names_keep_the_first_in_order(table):
    raw = table(strings(fixed.CATEGORY_COLUMNS), ("Redes-x", "b_two"), ("redes x", "a_one"), (" ", None))
    clean = silver.clean_category_dataframe(raw, order_by=["product_category_name_english"])
    assert {tuple(r) for r in clean.collect()} == {("redes x", "A_One"), ("unknown", "")}
    with pytest.raises(ValueError, match="order_by"):
        silver.clean_category_dataframe(raw)
    with pytest.raises(ValueError, match="missing required column"):
        silver.clean_category_dataframe(raw.select("product_category_name"))
