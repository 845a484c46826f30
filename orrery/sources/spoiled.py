"""Finished tables with faults put in, so that every rule has something to find.

A row gets a number from the hash of its key, and the edits name the rows they touch by
that number.  Conditions and values are plain SQL that Spark and DuckDB read alike; the
SQL counterparts use the same list, as it describes an input and not a rule.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NUMBER = "spoil_no"


@dataclass(frozen=True)
class Spoil:
    """`edits`: (condition, column, value); `copies`, `drop`: conditions."""

    keys: Sequence[str]
    edits: Sequence[tuple[str, str, str]]
    copies: str = "false"
    drop: str = "false"

    def columns(self, names: Sequence[str]) -> list[str]:
        """SQL of every column after the edits; the first edit that applies wins."""
        out = []
        for name in names:
            cases = "".join(f" WHEN {when} THEN {value}" for when, column, value in self.edits if column == name)
            out.append(f"CASE{cases} ELSE {name} END AS {name}" if cases else name)
        return out


def _rows(modulus: int, *edits: tuple[str, str] | Sequence[tuple[str, str]]) -> list[tuple[str, str, str]]:
    """Edit k goes to the rows with number k modulo `modulus`; a list of edits shares its rows."""
    out = []
    for k, edit in enumerate(edits):
        for column, value in [edit] if isinstance(edit, tuple) else edit:
            out.append((f"{NUMBER} % {modulus} = {k}", column, value))
    return out


def _nulls(**types: str) -> list[tuple[str, str]]:
    return [(column, f"CAST(NULL AS {kind})") for column, kind in types.items()]


_NAN, _INF = "CAST('NaN' AS DOUBLE)", "CAST('Infinity' AS DOUBLE)"
_TEXTS = dict.fromkeys(("is_black_friday", "event_window", "is_weekend", "event_period", "period_group"), "STRING")
_NUMBERS = dict.fromkeys(("date_key", "year", "month", "dow", "event_period_sort", "period_group_sort"), "INT")

SPOILS: dict[str, Spoil] = {
    "customers": Spoil(("customer_id", "customer_unique_id"), _rows(
        11, *_nulls(customer_id="STRING", customer_unique_id="STRING", customer_city="STRING", customer_state="STRING"),
        ("customer_state", "'ZZ'"), ("customer_zip_code_prefix", "12")), copies=f"{NUMBER} % 11 = 6"),
    "sellers": Spoil(("seller_id",), _rows(
        7, *_nulls(seller_id="STRING", seller_city="STRING", seller_state="STRING"),
        ("seller_state", "'ZZ'"), ("seller_zip_code_prefix", "12")), copies=f"{NUMBER} % 7 = 5"),
    "orders": Spoil(("order_id",), _rows(
        13, *_nulls(order_id="STRING", customer_id="STRING", order_status="STRING", order_purchase_timestamp="TIMESTAMP"),
        ("order_status", "'lost'"), ("order_approved_at", "order_purchase_timestamp - INTERVAL 1 DAY"),
        ("order_delivered_carrier_date", "order_purchase_timestamp - INTERVAL 1 DAY")), copies=f"{NUMBER} % 13 = 7"),
    "order_items": Spoil(("order_id", "order_item_id", "product_id", "seller_id"), _rows(
        17, *_nulls(order_id="STRING", order_item_id="INT", product_id="STRING", seller_id="STRING", shipping_limit_date="TIMESTAMP"),
        ("order_item_id", "-1"), ("price", "CAST(-1.0 AS DOUBLE)"), ("freight_value", "CAST(-1.0 AS DOUBLE)"),
        ("price", "CAST(NULL AS DOUBLE)")), copies=f"{NUMBER} % 17 = 9"),
    "payments": Spoil(("order_id", "payment_sequential", "payment_type"), _rows(
        19, *_nulls(order_id="STRING", payment_sequential="INT", payment_type="STRING", payment_installments="INT", payment_value="DOUBLE"),
        ("order_id", "'short'"), ("payment_sequential", "0"), ("payment_value", "CAST(-5.0 AS DOUBLE)"), ("payment_installments", "-2"),
        [("payment_type", "'credit_card'"), ("payment_installments", "0")], ("payment_type", "'bitcoin'"),
        ("payment_value", "CAST(0.0 AS DOUBLE)"), [("payment_type", "'boleto'"), ("payment_installments", "0")]), copies=f"{NUMBER} % 19 = 13"),
    "products": Spoil(("product_id", "product_category_name"), _rows(
        13, *_nulls(product_id="STRING"), ("product_id", "'ABC'"), ("product_category_name", "'Bad_Name'"), ("product_weight_g", "-1"),
        ("product_name_length", "0"), ("product_description_length", "0"), ("product_length_cm", "0"), ("product_height_cm", "0"),
        ("product_width_cm", "0"), ("product_photos_qty", "0")), copies=f"{NUMBER} % 13 = 10"),
    "reviews": Spoil(("review_id", "order_id"), _rows(
        11, *_nulls(review_id="STRING"), ("review_comment_title", "''"), ("review_score", "9"),
        ("review_answer_timestamp", "review_creation_date - INTERVAL 1 DAY"), ("review_comment_message", "'a' || chr(10) || 'b'"),
        ("order_id", "'nowhere'")), copies=f"{NUMBER} % 11 = 6"),
    "category": Spoil(("product_category_name",), _rows(3, *_nulls(product_category_name="STRING"))),
    "category_names": Spoil(("product_category_name",), _rows(3, *_nulls(product_category_name="STRING")), copies=f"{NUMBER} % 3 = 1"),
    "dim_customer": Spoil(("customer_unique_id",), _rows(
        11, *_nulls(customer_key="INT", customer_unique_id="STRING", first_order_date="STRING", state="STRING", city="STRING"),
        ("state", "'ZZ'"), ("city", "' Up '"), ("first_order_date", "'not a date'"), ("first_order_date", "'2999-01-01'")), copies=f"{NUMBER} % 11 = 9"),
    "dim_date": Spoil(("date_key",), [
        *_rows(41, *_nulls(**_NUMBERS), *_nulls(**_TEXTS), *_nulls(date="STRING"), ("date", "'1998/02/03'"), ("date", "'1998-02-31'"),
               *((c, f"{c} + 50") for c in _NUMBERS), *((c, "'wrong'") for c in _TEXTS)),
        ("event_period_sort <= 3 AND dow = 6", "event_period", "'Other days'")],
        copies=f"{NUMBER} % 41 = 30", drop=f"{NUMBER} % 41 IN (31, 32, 33)"),
    "dim_product": Spoil(("product_id",), _rows(
        13, *_nulls(product_key="INT", product_id="STRING", category_en="STRING"), ("baseline_price_med", "CAST(-1.0 AS DOUBLE)"),
        ("baseline_price_med", _NAN), ("baseline_price_med", _INF), ("category_en", "'Bad_Name'")), copies=f"{NUMBER} % 13 = 7"),
    "dim_seller": Spoil(("seller_id",), _rows(
        7, *_nulls(seller_key="INT", seller_id="STRING", seller_state="STRING", seller_city="STRING"),
        [("seller_state", "'ZZ'"), ("seller_city", "' Up'")]), copies=f"{NUMBER} % 7 = 5"),
    "fact_order": Spoil(("order_id",), _rows(
        17, *_nulls(order_id="STRING", date_key="INT", customer_key="INT", is_new_at_order="BOOLEAN"), ("order_value", "CAST(-1.0 AS DOUBLE)"),
        ("order_value", _NAN), ("item_count", "-1"), ("payment_value_total", _INF), ("payment_value_total", "CAST(NULL AS DOUBLE)")), copies=f"{NUMBER} % 17 = 9"),
    "fact_order_item": Spoil(("order_id", "order_item_id", "product_key"), _rows(
        23, *_nulls(order_item_id="INT", order_id="STRING", date_key="INT", customer_key="INT", product_key="INT", seller_key="INT", price="DOUBLE", freight_value="DOUBLE"),
        ("order_item_id", "0"), ("price", _NAN), ("price", "CAST(-1.0 AS DOUBLE)"), ("freight_value", _INF), ("freight_value", "CAST(-1.0 AS DOUBLE)"),
        ("price_vs_baseline_pct", _NAN), ("price_vs_baseline_pct", _INF), ("order_id", "'nowhere'")), copies=f"{NUMBER} % 23 = 16"),
    "fact_review": Spoil(("review_id", "order_id"), _rows(
        11, *_nulls(review_id="STRING", order_id="STRING", order_date_key="INT", review_score="INT"), ("review_score", "9"),
        ("order_date_key", "1")), copies=f"{NUMBER} % 11 = 6"),
}


def spoiled(df: DataFrame, name: str) -> DataFrame:
    """`df` with the faults listed under `name`; one pass, nothing is shuffled."""
    spoil = SPOILS[name]
    key = ", ".join(f"CAST({k} AS STRING)" for k in spoil.keys)
    number = F.expr(f"CAST(conv(substr(md5(concat_ws('|', {key})), 1, 6), 16, 10) AS BIGINT)")
    numbered = df.withColumn(NUMBER, number).where(f"NOT ({spoil.drop})")
    copies = f"explode(CASE WHEN {spoil.copies} THEN array(0, 1) ELSE array(0) END) AS spoil_copy"
    return numbered.selectExpr(*spoil.columns(df.columns), copies).drop("spoil_copy")
