"""Rule sets of all tables, and the validators built on them.

A rule set is a function because Columns need a running session.  The validators
keep three ways of answering: return the table or raise on the first broken rule,
raise once with all broken rules, or hand back a report.

A NULL never breaks a range, list or comparison rule; missing values are the
business of the `is null` rules.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery import fixed
from orrery.functions import casting, measures, text
from orrery.functions.days import black_friday, calendar_attributes
from orrery.operators.headers import missing_columns
from orrery.operators.rules import (
    ERROR,
    WARNING,
    Finding,
    ReferenceRule,
    Report,
    RowRule,
    RuleSet,
    RuleViolation,
    SameSizeRule,
    TableRule,
    UniqueRule,
    not_null,
    one_of,
    outside,
)

# The strict payments validator raises this.
ValidationError = RuleViolation

# Rules are called <column or subject>.<fault>.
_MISSING = "{}.missing"


def _no_rows() -> Column:
    return F.when(F.count(F.lit(1)) == 0, 1).otherwise(0)


def _or_raise(rules: RuleSet, df: DataFrame) -> DataFrame:
    rules.report(df).raise_first()
    return df


def _or_raise_all(rules: RuleSet, df: DataFrame) -> DataFrame:
    rules.report(df).raise_all()
    return df


# ------------------------------------------------------- customers and sellers
def _party_rules(dataset: str, prefix: str, ids: Iterable[str]) -> RuleSet:
    zip_code, city, state = f"{prefix}_zip_code_prefix", f"{prefix}_city", f"{prefix}_state"
    return RuleSet(
        dataset,
        (*ids, zip_code, city, state),
        [
            *not_null([*ids, city, state], _MISSING),
            one_of(state, fixed.STATE_CODES, f"{state}.unknown"),
            UniqueRule(f"{prefix}_id.repeated", (f"{prefix}_id",)),
            outside(zip_code, *fixed.ZIP_RANGE, f"{zip_code}.out_of_range"),
        ],
    )


def customer_rules() -> RuleSet:
    return _party_rules("silver_customers", "customer", ["customer_id", "customer_unique_id"])


def seller_rules() -> RuleSet:
    return _party_rules("silver_sellers", "seller", ["seller_id"])


def validate_customers(df: DataFrame) -> DataFrame:
    return _or_raise(customer_rules(), df)


def validate_sellers(df: DataFrame) -> DataFrame:
    return _or_raise(seller_rules(), df)


# ------------------------------------------------------------ orders and items
def order_rules() -> RuleSet:
    purchase = F.col("order_purchase_timestamp")
    required = ["order_id", "customer_id", "order_status", "order_purchase_timestamp"]

    def too_early(column: str) -> RowRule:
        return RowRule(f"{column}.before_purchase", column,
                       F.col(column) < purchase)

    return RuleSet(
        "silver_orders",
        fixed.ORDER_COLUMNS,
        [
            *not_null(required, _MISSING),
            UniqueRule("order_id.repeated", ("order_id",)),
            one_of("order_status", fixed.ORDER_STATUSES, "order_status.unknown"),
            too_early("order_approved_at"),
            too_early("order_delivered_carrier_date"),
        ],
    )


def order_item_rules() -> RuleSet:
    price, freight = F.col("price"), F.col("freight_value")
    ids = ["order_id", "order_item_id", "product_id", "seller_id"]
    return RuleSet(
        "silver_order_items",
        fixed.ITEM_COLUMNS,
        [
            *not_null(ids, _MISSING),
            UniqueRule("order_line.repeated",
                       ("order_id", "order_item_id")),
            RowRule("order_item_id.not_positive", "order_item_id",
                    F.col("order_item_id") <= 0),
            RowRule("price.not_positive", "price", price.isNull() | (price <= 0)),
            RowRule("freight_value.negative", "freight_value",
                    freight.isNull() | (freight < 0)),
            *not_null(["shipping_limit_date"], _MISSING),
        ],
    )


def validate_orders(df: DataFrame) -> DataFrame:
    return _or_raise(order_rules(), df)


def validate_order_items(df: DataFrame) -> DataFrame:
    return _or_raise(order_item_rules(), df)


# ------------------------------------------------------------------- payments
_BAD_TYPE = "payment_type.unknown"


def payment_rules() -> RuleSet:
    card = F.col("payment_type") == "credit_card"
    installments, value = F.col("payment_installments"), F.col("payment_value")
    return RuleSet(
        "silver_order_payments",
        fixed.PAYMENT_COLUMNS,
        [
            *not_null(fixed.PAYMENT_COLUMNS, _MISSING),
            RowRule("order_id.wrong_length", "order_id",
                    F.length("order_id") != fixed.ID_LENGTH),
            RowRule("payment_sequential.below_one", "payment_sequential",
                    F.col("payment_sequential") < 1),
            RowRule("payment_value.negative", "payment_value", value < 0),
            RowRule("payment_installments.negative", "payment_installments", installments < 0),
            RowRule("payment_installments.none_on_card", "payment_installments",
                    card & (installments == 0)),
            one_of("payment_type", fixed.PAYMENT_TYPES, _BAD_TYPE),
            UniqueRule("payment.repeated",
                       ("order_id", "payment_sequential"), count="rows"),
            RowRule("payment_value.zero", "payment_value", value == 0, WARNING),
            RowRule("payment_installments.zero", "payment_installments",
                    ~card & (installments == 0), WARNING),
        ],
        types=fixed.PAYMENT_TYPES_BY_COLUMN,
    )


def validate_order_payments(df: DataFrame, strict: bool = True) -> dict:
    """{passed, errors, warnings, row_count}; strict raises when there are errors.

    Unknown payment types are listed in full in a frame: `offenders` of the answer, or
    of the exception.
    """
    rules = payment_rules()
    report = rules.report(df)
    offenders = payment_type_offenders(df) if report.bad_rows(_BAD_TYPE) else None
    if strict:
        try:
            report.raise_all()
        except RuleViolation as violation:
            violation.offenders = offenders
            raise
    answer = report.as_dict()
    if offenders is not None:
        answer["offenders"] = offenders
    return answer


def payment_type_offenders(df: DataFrame) -> DataFrame:
    """(invalid_value, bad_rows): every unknown payment type."""
    return payment_rules().offenders(df, _BAD_TYPE)


# ------------------------------------------------------------------- products
def product_rules() -> RuleSet:
    category = F.col("product_category_name")
    lengths = [c for c in fixed.PRODUCT_MEASURES if "length" in c or c.endswith("_cm")]
    return RuleSet(
        "silver_products",
        fixed.PRODUCT_COLUMNS,
        [
            *not_null(["product_id"], _MISSING),
            RowRule("product_id.not_hex", "product_id",
                    ~F.col("product_id").rlike(fixed.HEX_ID)),
            RowRule("product_category_name.untidy", "product_category_name",
                    category.isNotNull() & ~measures.tidy(category, text.category_key)),
            RowRule("product_weight_g.negative", "product_weight_g",
                    F.col("product_weight_g") < 0),
            *(RowRule(f"{c}.not_positive", c, F.col(c) <= 0) for c in lengths),
            RowRule("product_photos_qty.below_one", "product_photos_qty",
                    F.col("product_photos_qty") < 1),
            UniqueRule("product_id.repeated", ("product_id",), count="surplus", skip_null=True),
        ],
    )


def validate_products(df: DataFrame) -> DataFrame:
    return _or_raise_all(product_rules(), df)


# -------------------------------------------------------------------- reviews
_NAMES = fixed.REVIEW_CHECKS
_REVIEW_TYPES = {
    _NAMES["created_type"]: ("review_creation_date", "timestamp"),
    _NAMES["answered_type"]: ("review_answer_timestamp", "timestamp"),
    _NAMES["score_type"]: ("review_score", "int"),
}


def review_rules(
    orders_df: DataFrame | None = None, expect_one_review_per_order: bool = False
) -> RuleSet:
    title, message = F.col("review_comment_title"), F.col("review_comment_message")
    any_key_null = F.lit(False)
    for c in fixed.REVIEW_KEYS:
        any_key_null = any_key_null | F.col(c).isNull()

    def empty(comment: Column) -> Column:
        return comment.isNull() | (comment == "")

    rules = [
        RowRule(_NAMES["keys"], "review_id", any_key_null),
        RowRule(_NAMES["comments"], "review_id", empty(title) | empty(message)),
        outside("review_score", *fixed.SCORE_RANGE, _NAMES["score"]),
        UniqueRule(_NAMES["unique"], ("review_id", "order_id")),
        RowRule(_NAMES["order"], "review_answer_timestamp",
                F.col("review_answer_timestamp") < F.col("review_creation_date")),
        RowRule(_NAMES["line_breaks"], "review_id",
                title.rlike("[\r\n]") | message.rlike("[\r\n]")),
    ]
    if expect_one_review_per_order:
        rules.append(UniqueRule(_NAMES["one_per_order"], ("order_id",)))
    if orders_df is not None:
        rules.append(
            ReferenceRule(_NAMES["orders_exist"], ("order_id",), orders_df, distinct=True)
        )
    return RuleSet("silver_order_reviews", fixed.REVIEW_COLUMNS, rules)


def validate_reviews(
    df: DataFrame,
    orders_df: DataFrame | None = None,
    expect_one_review_per_order: bool = False,
) -> list[dict]:
    """One {check, passed, detail} per check; wrong types are reported, not raised."""
    missing = missing_columns(df, fixed.REVIEW_COLUMNS)
    results = [_check(_NAMES["columns"], not missing, f"missing: {missing}")]
    if missing:
        return results
    actual = dict(df.dtypes)
    for check, (column, wanted) in _REVIEW_TYPES.items():
        results.append(_check(check, actual[column] == wanted, actual[column]))
    # Text columns are read as numbers and times here, so that the rules can be
    # evaluated at all; the type checks above have already failed for them.
    typed = df.withColumns(
        {
            column: F.col(column).try_cast(wanted)
            for column, wanted in _REVIEW_TYPES.values()
            if actual[column] == "string"
        }
    )
    report = review_rules(orders_df, expect_one_review_per_order).report(typed)
    results += [
        _check(f.rule, f.bad_rows == 0, f"found: {f.bad_rows}") for f in report.findings
    ]
    return results


def _check(name: str, passed: bool, detail: str) -> dict:
    return {"check": name, "passed": passed, "detail": detail}


def review_report(checked: list[dict]) -> Report:
    """The list of `validate_reviews` as a report: one finding per check, with its detail as the example."""
    findings = [Finding(c["check"], ERROR, int(not c["passed"]), c["detail"]) for c in checked]
    return Report("reviews", None, findings)


def all_passed(checked: list[dict]) -> bool:
    return review_report(checked).passed


def print_report(checked: list[dict]) -> None:
    """One line per check, `[PASS]` or `[FAIL]` first."""
    lines = (
        f"[{'FAIL' if finding.bad_rows else 'PASS'}] {finding.rule} - {finding.example}"
        for finding in review_report(checked).findings
    )
    print(*lines, sep="\n")


def assert_valid(checked: list[dict]) -> None:
    """Raises with every failed check and its detail."""
    review_report(checked).raise_all()


# ----------------------------------------------------------------- categories
def category_rules() -> RuleSet:
    key = fixed.CATEGORY_COLUMNS[0]
    return RuleSet(
        "silver_product_category_name",
        fixed.CATEGORY_COLUMNS,
        [TableRule("table.empty", _no_rows()), *not_null([key], _MISSING)],
    )


def validate_category_translation(df: DataFrame) -> None:
    report = category_rules().report(df)
    assert report.passed, "; ".join(report.errors)


def category_frame_rules() -> RuleSet:
    key = fixed.CATEGORY_COLUMNS[0]
    return RuleSet(
        "product_category",
        fixed.CATEGORY_COLUMNS,
        [
            *not_null([key], _MISSING),
            UniqueRule(f"{key}.repeated", (key,), count="surplus"),
        ],
    )


def validate_category_dataframe(df: DataFrame) -> list[str]:
    """The names of the broken rules; an empty list means valid."""
    rules = category_frame_rules()
    missing = missing_columns(df, rules.columns)
    if missing:
        return [f"Missing required columns: {missing}"]
    return [f.rule for f in rules.report(df).findings if f.bad_rows]


# --------------------------------------------------------------- dim_customer
def dim_customer_rules() -> RuleSet:
    city = F.col("city")
    first = casting.to_time("first_order_date")
    return RuleSet(
        "gold_dim_customer",
        fixed.DIM_CUSTOMER_COLUMNS,
        [
            *not_null(fixed.DIM_CUSTOMER_COLUMNS, _MISSING),
            *(UniqueRule(f"{c}.repeated", (c,))
              for c in ("customer_key", "customer_unique_id")),
            one_of("state", fixed.STATE_CODES, "state.unknown"),
            RowRule("city.untidy", "city", city != text.lowered(city)),
            RowRule("first_order_date.unreadable", "first_order_date", first.isNull()),
            RowRule("first_order_date.future", "first_order_date",
                    first > F.current_timestamp()),
        ],
    )


def validate_dim_customer_gold(df: DataFrame) -> DataFrame:
    return _or_raise(dim_customer_rules(), df)


validate_customers_gold = validate_dim_customer_gold


# ------------------------------------------------------------------- dim_date
def dim_date_rules(study_year: int = fixed.STUDY_YEAR) -> RuleSet:
    """Every attribute is derived again from the date of the same row: no self-join."""
    as_text = F.col("date").cast("string")
    day = F.try_to_date(as_text, "yyyy-MM-dd")
    expected = calendar_attributes(day, study_year)
    derived = [c for c in fixed.DIM_DATE_COLUMNS if c != "date"]

    first, last = F.min(day), F.max(day)
    event = black_friday(F.lit(study_year))
    covered = (first <= F.date_sub(event, fixed.BEFORE_DAYS)) & (
        last >= F.date_add(event, fixed.EVENT_DAYS - 1 + fixed.AFTER_DAYS)
    )
    lengths = zip(fixed.PERIOD_LABELS, (fixed.BEFORE_DAYS, fixed.EVENT_DAYS, fixed.AFTER_DAYS))
    gap = F.datediff(last, first) + 1 - F.count(F.lit(1))
    return RuleSet(
        "gold_dim_date",
        fixed.DIM_DATE_COLUMNS,
        [
            *not_null(fixed.DIM_DATE_COLUMNS, _MISSING),
            *(UniqueRule(f"{c}.repeated", (c,)) for c in ("date_key", "date")),
            RowRule("date.wrong_format", "date", ~as_text.rlike(fixed.ISO_DATE)),
            RowRule("date.unreadable", "date", day.isNull()),
            *(RowRule(f"{c}.differs", c, day.isNotNull() & (F.col(c) != expected[c]))
              for c in derived),
            TableRule("calendar.gap", F.abs(gap)),
            *(
                TableRule(
                    f"{label}.wrong_length",
                    F.when(covered, F.abs(F.count_if(F.col("event_period") == label) - days)),
                )
                for label, days in lengths
            ),
        ],
    )


def validate_dim_date_gold(df: DataFrame, study_year: int = fixed.STUDY_YEAR) -> DataFrame:
    return _or_raise(dim_date_rules(study_year), df)


validate_date_gold = validate_dim_date_gold


# ---------------------------------------------------------------- dim_product
def dim_product_rules(silver_products: DataFrame | None = None) -> RuleSet:
    """With `silver_products` the rules need `with_silver_category(dim, ...)` as input."""
    baseline, english = F.col("baseline_price_med"), F.col("category_en")
    rules = [
        *not_null(["product_key", "product_id"], _MISSING),
        RowRule("baseline_price_med.not_positive", "baseline_price_med",
                baseline.isNotNull() & (measures.not_finite(baseline) | (baseline <= 0))),
        RowRule("category_en.untidy", "category_en",
                english.isNotNull() & ~measures.tidy(english, text.display_text)),
        TableRule("table.empty", _no_rows()),
        UniqueRule("product_id.repeated", ("product_id",), count="surplus", skip_null=True),
    ]
    if silver_products is not None:
        rules += [
            RowRule("category_pt.untranslated",
                    "category_pt", english.isNull() & F.col("needs_english")),
            SameSizeRule("table.wrong_size", ("product_id",),
                         silver_products),
        ]
    return RuleSet("gold_dim_product", fixed.DIM_PRODUCT_COLUMNS, rules)


def with_silver_category(dim: DataFrame, silver_products: DataFrame) -> DataFrame:
    """Add `needs_english`: does Silver know a category that has to be translated?

    Silver is folded to one row per id first, so a repeated id cannot multiply rows.
    """
    category = F.col("product_category_name")
    needs = category.isNotNull() & ~category.isin(*fixed.KNOWN_UNTRANSLATED)
    by_id = silver_products.groupBy("product_id").agg(
        F.max(measures.is_true(needs)).alias("needs_english")
    )
    return dim.join(by_id, "product_id", "left")


def validate_dim_product_gold(dim: DataFrame, silver_products: DataFrame) -> DataFrame:
    for name, df, needed in (
        ("gold_dim_product", dim, fixed.DIM_PRODUCT_COLUMNS),
        ("Silver products", silver_products, ("product_id", "product_category_name")),
    ):
        missing = missing_columns(df, needed)
        if missing:
            raise RuleViolation(f"{name}: missing required column(s): {missing}")
    _or_raise_all(dim_product_rules(silver_products), with_silver_category(dim, silver_products))
    return dim


validate_product_gold = validate_dim_product_gold


# ----------------------------------------------------------------- dim_seller
def dim_seller_rules() -> RuleSet:
    city = F.col("seller_city")
    return RuleSet(
        "gold_dim_seller",
        fixed.DIM_SELLER_COLUMNS,
        [
            *(UniqueRule(f"{c}.repeated", (c,))
              for c in ("seller_key", "seller_id")),
            *not_null(fixed.DIM_SELLER_COLUMNS, _MISSING),
            one_of("seller_state", fixed.STATE_CODES, "seller_state.unknown"),
            RowRule("seller_city.untidy", "seller_city", city != text.lowered(city)),
        ],
    )


def validate_dim_seller_gold(df: DataFrame) -> DataFrame:
    return _or_raise(dim_seller_rules(), df)


validate_seller_gold = validate_dim_seller_gold


# ---------------------------------------------------------------------- facts
def fact_order_rules() -> RuleSet:
    required = ["order_id", "date_key", "customer_key", "is_new_at_order"]
    amounts = ["order_value", "item_count", "payment_value_total"]

    def bad_amount(c: str) -> Column:
        return F.col(c).isNull() | measures.not_finite(c) | (F.col(c) < 0)

    return RuleSet(
        "gold_fact_order",
        fixed.FACT_ORDER_COLUMNS,
        [
            *not_null(required, _MISSING),
            UniqueRule("order_id.repeated", ("order_id",)),
            *(RowRule(f"{c}.invalid", c, bad_amount(c))
              for c in amounts),
        ],
        types={"is_new_at_order": "boolean"},
    )


def validate_fact_orders_gold(df: DataFrame) -> DataFrame:
    return _or_raise(fact_order_rules(), df)


validate_orders_gold = validate_fact_orders_gold


def fact_order_item_rules(fact_orders: DataFrame | None = None) -> RuleSet:
    price, freight, percent = (
        F.col(c) for c in ("price", "freight_value", "price_vs_baseline_pct")
    )
    required = [c for c in fixed.FACT_ITEM_COLUMNS if c != "price_vs_baseline_pct"]
    pair = ("order_id", "order_item_id")
    rules = [
        *not_null(required, _MISSING),
        UniqueRule("order_line.repeated", pair),
        RowRule("order_item_id.not_positive", "order_item_id", F.col("order_item_id") <= 0),
        RowRule("price.invalid", "price",
                measures.not_finite(price) | (price <= 0)),
        RowRule("freight_value.invalid", "freight_value",
                measures.not_finite(freight) | (freight < 0)),
        RowRule("price_vs_baseline_pct.invalid", "price_vs_baseline_pct",
                measures.not_finite(percent)),
    ]
    if fact_orders is not None:
        rules.append(ReferenceRule("order_keys.orphan",
                                   ("order_id", "date_key", "customer_key"), fact_orders))
    return RuleSet("gold_fact_order_item", fixed.FACT_ITEM_COLUMNS, rules)


def validate_fact_order_item_gold(
    df: DataFrame, fact_orders: DataFrame | None = None
) -> DataFrame:
    return _or_raise(fact_order_item_rules(fact_orders), df)


validate_order_item_gold = validate_fact_order_item_gold


def fact_review_rules(fact_orders: DataFrame | None = None) -> RuleSet:
    rules = [
        *not_null(fixed.FACT_REVIEW_COLUMNS, _MISSING),
        outside("review_score", *fixed.SCORE_RANGE,
                "review_score.out_of_range"),
        UniqueRule("review_id.repeated", ("review_id",)),
    ]
    if fact_orders is not None:
        parent = fact_orders.select("order_id", F.col("date_key").alias("order_date_key"))
        rules.append(
            ReferenceRule("order_keys.orphan",
                          ("order_id", "order_date_key"), parent)
        )
    return RuleSet("gold_fact_review", fixed.FACT_REVIEW_COLUMNS, rules)


def validate_fact_review_gold(
    df: DataFrame, fact_orders: DataFrame | None = None
) -> DataFrame:
    return _or_raise(fact_review_rules(fact_orders), df)


validate_review_gold = validate_fact_review_gold
