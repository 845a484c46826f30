"""One case per rule, made from the rule lists; then the ways in which validators answer."""

import pytest
from conftest import strings
from pyspark.sql import functions as F

from orrery import fixed
from orrery.operators.rules import RowRule, RuleSet, TableRule, UniqueRule
from orrery.plans import checks, dims, silver

NAN, INF = float("nan"), float("inf")
MOON = "2018-03-0%d 08:00:00"


def hexa(n: int) -> str:
    return f"{n:032x}"


def _missing(*columns):
    return {f"{c}.missing": {c: None} for c in columns}


class Case:
    """A rule set, a row it accepts, and per row rule a change that breaks it."""

    def __init__(self, rules, types, row, broken, key=None):
        self.rules, self.types, self.row, self.broken, self.key = rules, types, row, broken, key

    def frame(self, table, *changes):
        schema = "case_ string, " + ", ".join(f"{c} {t}" for c, t in self.types.items())
        rows = []
        for n, (name, change) in enumerate(changes, 1):
            row = {**self.row, **(self.key(n) if self.key else {}), **change}
            rows.append((name, *(row[c] for c in self.types)))
        df = table(schema, *rows)
        times = {c: F.col(c).cast("timestamp") for c in self.types if c in TIMES}
        return df.withColumns(times) if times else df


TIMES = {*fixed.ORDER_TIMES, "shipping_limit_date", "review_creation_date", "review_answer_timestamp"}


def party(prefix, *ids):
    types = {**dict.fromkeys(ids, "string"), f"{prefix}_zip_code_prefix": "int", f"{prefix}_city": "string", f"{prefix}_state": "string"}
    row = {**dict.fromkeys(ids, "k"), f"{prefix}_zip_code_prefix": 45000, f"{prefix}_city": "ilhabela", f"{prefix}_state": "BA"}
    broken = {
        **_missing(*ids, f"{prefix}_city", f"{prefix}_state"),
        f"{prefix}_state.unknown": {f"{prefix}_state": "QQ"},
        f"{prefix}_zip_code_prefix.out_of_range": {f"{prefix}_zip_code_prefix": 100_000},
    }
    return types, row, broken, lambda n: {f"{prefix}_id": f"{prefix}-{n}"}


ORDER = {**dict.fromkeys(fixed.ORDER_COLUMNS, "string")}
ITEM = {"order_id": "string", "order_item_id": "int", "product_id": "string", "seller_id": "string", "shipping_limit_date": "string", "price": "double", "freight_value": "double"}
PRODUCT = {"product_id": "string", "product_category_name": "string", **dict.fromkeys(fixed.PRODUCT_MEASURES, "int")}
REVIEW = {"review_id": "string", "order_id": "string", "review_score": "int", "review_comment_title": "string", "review_comment_message": "string", "review_creation_date": "string", "review_answer_timestamp": "string"}
DIM_CUSTOMER = {"customer_key": "int", "customer_unique_id": "string", "first_order_date": "string", "state": "string", "city": "string"}
DIM_PRODUCT = {"product_key": "int", "product_id": "string", "category_pt": "string", "category_en": "string", "weight_g": "int", "length_cm": "int", "height_cm": "int", "width_cm": "int", "baseline_price_med": "double"}
DIM_SELLER = {"seller_key": "int", "seller_id": "string", "seller_state": "string", "seller_city": "string"}
FACT_ORDER = {"order_id": "string", "date_key": "int", "customer_key": "int", "order_value": "double", "item_count": "bigint", "delivery_delay_days": "int", "payment_value_total": "double", "is_new_at_order": "boolean"}
FACT_ITEM = {"order_item_id": "int", "order_id": "string", "date_key": "int", "customer_key": "int", "product_key": "int", "seller_key": "int", "price": "double", "freight_value": "double", "price_vs_baseline_pct": "double"}
FACT_REVIEW = {"review_id": "string", "order_id": "string", "order_date_key": "int", "review_score": "int"}

CASES = {
    "customers": lambda: Case(checks.customer_rules(), *party("customer", "customer_id", "customer_unique_id")),
    "sellers": lambda: Case(checks.seller_rules(), *party("seller", "seller_id")),
    "orders": lambda: Case(
        checks.order_rules(), ORDER,
        {**dict.fromkeys(ORDER), "customer_id": "cu", "order_status": "shipped", "order_purchase_timestamp": MOON % 4},
        {
            **_missing("order_id", "customer_id", "order_status", "order_purchase_timestamp"),
            "order_status.unknown": {"order_status": "on the moon"},
            "order_approved_at.before_purchase": {"order_approved_at": MOON % 3},
            "order_delivered_carrier_date.before_purchase": {"order_delivered_carrier_date": MOON % 1},
        },
        lambda n: {"order_id": f"ord-{n}"}),
    "order_items": lambda: Case(
        checks.order_item_rules(), ITEM,
        {"order_item_id": 3, "product_id": "pr", "seller_id": "se", "shipping_limit_date": MOON % 7, "price": 0.01, "freight_value": 0.0},
        {
            **_missing("order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date"),
            "order_item_id.not_positive": {"order_item_id": -4}, "price.not_positive": {"price": 0.0},
            "freight_value.negative": {"freight_value": -0.01},
        },
        lambda n: {"order_id": f"ord-{n}"}),
    "payments": lambda: Case(
        checks.payment_rules(), fixed.PAYMENT_TYPES_BY_COLUMN,
        {"payment_sequential": 2, "payment_type": "debit_card", "payment_installments": 7, "payment_value": 81.25},
        {
            **_missing(*fixed.PAYMENT_COLUMNS),
            "order_id.wrong_length": {"order_id": "0" * 31}, "payment_sequential.below_one": {"payment_sequential": -1},
            "payment_value.negative": {"payment_value": -0.5}, "payment_installments.negative": {"payment_installments": -3},
            "payment_installments.none_on_card": {"payment_type": "credit_card", "payment_installments": 0},
            "payment_type.unknown": {"payment_type": "shells"}, "payment_value.zero": {"payment_value": 0.0},
            "payment_installments.zero": {"payment_installments": 0},
        },
        lambda n: {"order_id": hexa(n)}),
    "products": lambda: Case(
        checks.product_rules(), PRODUCT,
        {"product_category_name": "garden chairs", **dict.fromkeys(fixed.PRODUCT_MEASURES, 6)},
        {
            "product_id.missing": {"product_id": None}, "product_id.not_hex": {"product_id": "G" * 32},
            "product_category_name.untidy": {"product_category_name": "Garden-Chairs"},
            "product_weight_g.negative": {"product_weight_g": -2},
            **{f"{c}.not_positive": {c: 0} for c in fixed.PRODUCT_MEASURES if "length" in c or c.endswith("_cm")},
            "product_photos_qty.below_one": {"product_photos_qty": 0},
        },
        lambda n: {"product_id": hexa(n)}),
    "reviews": lambda: Case(
        checks.review_rules(), REVIEW,
        {"order_id": "ord", "review_score": 2, "review_comment_title": "meh", "review_comment_message": "it creaks", "review_creation_date": MOON % 5, "review_answer_timestamp": MOON % 6},
        {
            "no_nulls_in_key_columns": {"review_score": None}, "comments_filled": {"review_comment_title": ""},
            "score_between_1_and_5": {"review_score": 0}, "answer_after_creation": {"review_answer_timestamp": MOON % 4},
            "no_line_breaks_in_comments": {"review_comment_message": "it\rcreaks"},
        },
        lambda n: {"review_id": f"rev-{n}"}),
    "dim_customer": lambda: Case(
        checks.dim_customer_rules(), DIM_CUSTOMER,
        {"first_order_date": "2017-06-30", "state": "AM", "city": "manaus"},
        {
            **_missing(*DIM_CUSTOMER), "state.unknown": {"state": "am"}, "city.untidy": {"city": "Manaus"},
            "first_order_date.unreadable": {"first_order_date": "mid June"}, "first_order_date.future": {"first_order_date": "2345-06-07"},
        },
        lambda n: {"customer_key": n, "customer_unique_id": f"person-{n}"}),
    "dim_product": lambda: Case(
        checks.dim_product_rules(), DIM_PRODUCT,
        {"category_pt": "cadeiras", "category_en": "garden chairs", "weight_g": 9, "length_cm": 8, "height_cm": 7, "width_cm": 6, "baseline_price_med": 0.5},
        {
            **_missing("product_key", "product_id"), "baseline_price_med.not_positive": {"baseline_price_med": NAN},
            "category_en.untidy": {"category_en": "Garden_chairs"},
        },
        lambda n: {"product_key": n, "product_id": hexa(n)}),
    "dim_seller": lambda: Case(
        checks.dim_seller_rules(), DIM_SELLER, {"seller_state": "TO", "seller_city": "palmas"},
        {**_missing(*DIM_SELLER), "seller_state.unknown": {"seller_state": "T0"}, "seller_city.untidy": {"seller_city": " palmas"}},
        lambda n: {"seller_key": n, "seller_id": f"shop-{n}"}),
    "fact_order": lambda: Case(
        checks.fact_order_rules(), FACT_ORDER,
        {"date_key": 20170630, "customer_key": 5, "order_value": 0.0, "item_count": 0, "delivery_delay_days": None, "payment_value_total": 12.5, "is_new_at_order": False},
        {
            **_missing("order_id", "date_key", "customer_key", "is_new_at_order"), "order_value.invalid": {"order_value": INF},
            "item_count.invalid": {"item_count": -1}, "payment_value_total.invalid": {"payment_value_total": NAN},
        },
        lambda n: {"order_id": f"ord-{n}"}),
    "fact_order_item": lambda: Case(
        checks.fact_order_item_rules(), FACT_ITEM,
        {"order_item_id": 1, "date_key": 20170630, "customer_key": 5, "product_key": 6, "seller_key": 7, "price": 3.75, "freight_value": 0.0, "price_vs_baseline_pct": None},
        {
            **_missing(*(c for c in FACT_ITEM if c != "price_vs_baseline_pct")), "order_item_id.not_positive": {"order_item_id": 0},
            "price.invalid": {"price": -INF}, "freight_value.invalid": {"freight_value": NAN},
            "price_vs_baseline_pct.invalid": {"price_vs_baseline_pct": INF},
        },
        lambda n: {"order_id": f"ord-{n}"}),
    "fact_review": lambda: Case(
        checks.fact_review_rules(), FACT_REVIEW, {"order_id": "ord", "order_date_key": 20170630, "review_score": 4},
        {**_missing(*FACT_REVIEW), "review_score.out_of_range": {"review_score": 6}},
        lambda n: {"review_id": f"rev-{n}"}),
}


@pytest.mark.parametrize("name", CASES)
def test_each_row_rule_finds_its_row(table, name):
    case = CASES[name]()
    row_rules = [r for r in case.rules.rules if isinstance(r, RowRule)]
    assert set(case.broken) == {r.name for r in row_rules}
    df = case.frame(table, ("good", {}), *case.broken.items())
    marked = RuleSet(name, case.rules.columns, row_rules).annotate(df, "error")
    found = {r["case_"]: {b["rule"] for b in r["broken_rules"]} for r in marked.collect()}
    assert found["good"] == set()
    for rule in row_rules:
        if rule.severity == "error":
            assert rule.name in found[rule.name], rule.name
    counted = {r["rule"]: r["bad_rows"] for r in RuleSet(name, case.rules.columns, row_rules).counts(df).collect()}
    assert counted["row_count"] == 1 + len(case.broken) and all(counted[r.name] for r in row_rules)


@pytest.mark.parametrize("name", CASES)
def test_each_key_rule_finds_copies(table, name):
    case = CASES[name]()
    case.key, (first, second) = None, (case.key(1), case.key(2))
    unique = [r for r in case.rules.rules if isinstance(r, UniqueRule)]
    rules = RuleSet(name, case.rules.columns, unique)
    once = case.frame(table, ("a", first), ("b", second))
    twice = case.frame(table, ("a", first), ("b", first), ("c", second))
    counts = lambda df: {r["rule"]: r["bad_rows"] for r in rules.counts(df).collect()}
    if unique:
        assert not any(counts(once)[r.name] for r in unique)
        assert {counts(twice)[r.name] for r in unique} <= {1, 2} and all(counts(twice)[r.name] for r in unique)


def test_spoiled_tables_cover_every_rule_set():
    from orrery.queries import _RULED
    from orrery.sources.spoiled import SPOILS

    assert set(SPOILS) == set(_RULED)


# ------------------------------------------------------------------- protocols
def test_first_broken_rule_is_raised_and_good_tables_come_back(table):
    case = CASES["customers"]()
    good = case.frame(table, ("x", {}))
    assert checks.validate_customers(good) is good
    with pytest.raises(checks.ValidationError, match="customer_state.unknown"):
        checks.validate_customers(case.frame(table, ("x", {"customer_state": "QQ"}), ("y", {"customer_zip_code_prefix": 1})))
    assert checks.validate_customers(case.frame(table, ("x", {"customer_zip_code_prefix": None}))).count() == 1
    with pytest.raises(ValueError, match="missing required column.s.: .'customer_city'."):
        checks.validate_customers(good.drop("customer_city"))


def test_all_broken_rules_are_raised_at_once(table):
    case = CASES["products"]()
    case.key = lambda n: {"product_id": hexa(77)}
    bad = case.frame(table, ("a", {"product_weight_g": -1}), ("b", {"product_weight_g": -9, "product_photos_qty": 0}))
    with pytest.raises(ValueError) as error:
        checks.validate_products(bad)
    for part in ("product_weight_g.negative (2 rows)", "product_photos_qty.below_one (1 rows)", "product_id.repeated (1 rows)"):
        assert part in str(error.value)
    empty = {c: None for c in fixed.PRODUCT_COLUMNS if c != "product_id"}
    assert checks.validate_products(case.frame(table, ("a", empty))).count() == 1
    nulls = case.frame(table, ("a", {"product_id": None}), ("b", {"product_id": None}))
    with pytest.raises(ValueError) as error:
        checks.validate_products(nulls)
    assert "repeated" not in str(error.value)


def test_payment_report_names_every_offender(table):
    case = CASES["payments"]()
    odd = [(f"c{k}", {"payment_type": f"shell {k:02d}"}) for k in range(40)]
    df = case.frame(table, ("ok", {}), *odd).drop("case_")
    report = checks.validate_order_payments(df, strict=False)
    assert not report["passed"] and report["row_count"] == 41
    assert report["offenders"].count() == 40
    with pytest.raises(checks.ValidationError, match="payment_type.unknown .40 rows.") as error:
        checks.validate_order_payments(df)
    assert {r["invalid_value"] for r in error.value.offenders.collect()} == {f"shell {k:02d}" for k in range(40)}


def test_payment_warnings_and_types(table):
    case = CASES["payments"]()
    zero = case.frame(table, ("a", {"payment_value": 0.0}), ("b", {"payment_installments": 0})).drop("case_")
    report = checks.validate_order_payments(zero)
    assert report["passed"] and {w.split(" (")[0] for w in report["warnings"]} == {"payment_value.zero", "payment_installments.zero"}
    nothing = case.frame(table).drop("case_")
    assert checks.validate_order_payments(nothing) == {"passed": True, "errors": [], "warnings": [], "row_count": 0}
    text = table(strings(fixed.PAYMENT_COLUMNS), (hexa(1), "2", "voucher", "1", "5"))
    assert any("payment_value is string" in e for e in checks.validate_order_payments(text, strict=False)["errors"])
    assert [tuple(r)[:3] for r in checks.payment_rules().counts(text).collect()] == [("schema", "error", 3)]


def test_review_check_list(table, capsys):
    case = CASES["reviews"]()
    df = case.frame(table, ("a", {}), ("b", {})).drop("case_")
    full = checks.validate_reviews(df, orders_df=table("order_id string", ("elsewhere",)), expect_one_review_per_order=True)
    failed = lambda results: {r["check"] for r in results if not r["passed"]}
    assert failed(full) == {"one_review_per_order", "order_ids_exist_in_orders"} and not checks.all_passed(full)
    checks.print_report(full)
    assert "[FAIL] one_review_per_order" in capsys.readouterr().out
    with pytest.raises(ValueError):
        checks.assert_valid(full)
    assert checks.all_passed(checks.validate_reviews(df))
    assert failed(checks.validate_reviews(df.drop("review_id"))) == {"required_columns_present"}
    text = df.select(*(F.col(c).cast("string") for c in df.columns))
    assert failed(checks.validate_reviews(text)) == {"creation_date_is_timestamp", "answer_timestamp_is_timestamp", "score_is_int"}


def test_categories(table):
    schema = strings(fixed.CATEGORY_COLUMNS)
    checks.validate_category_translation(table(schema, ("bancos", "Benches")))
    for rows in ((), ((None, "Benches"),)):
        with pytest.raises(AssertionError):
            checks.validate_category_translation(table(schema, *rows))
    twice = table(schema, ("bancos", "Benches"), ("bancos", "Stools"), (None, ""))
    assert checks.validate_category_dataframe(twice) == ["product_category_name.missing", "product_category_name.repeated"]


# -------------------------------------------------------------------- calendar
CALENDAR_FAULTS = {
    "date_key.repeated": lambda d: d.union(d.limit(1)),
    "date.missing": lambda d: d.withColumn("date", F.when(F.col("month") != 8, F.col("date"))),
    "date.wrong_format": lambda d: d.withColumn("date", F.date_format("date", "dd.MM.yyyy")),
    "date.unreadable": lambda d: d.withColumn("date", F.lit("2016-02-30")),
    "calendar.gap": lambda d: d.where("date_key <> 20160229"),
    **{f"{c}.differs": (lambda d, c=c: d.withColumn(c, F.lit(7))) for c in ("date_key", "year", "month", "dow", "event_period_sort", "period_group_sort")},
    **{f"{c}.differs": (lambda d, c=c: d.withColumn(c, F.lit("?"))) for c in ("is_black_friday", "event_window", "is_weekend", "event_period", "period_group")},
    "Post 28 days.wrong_length": lambda d: d.withColumn("event_period", F.when(F.col("date_key") == 20161201, "Other days").otherwise(F.col("event_period"))),
}


def test_calendar_faults(spark):
    good = dims.build_dim_date(spark, "2016-01-01", "2016-12-31", study_year=2016)
    assert checks.validate_date_gold(good, study_year=2016) is good
    rules = checks.dim_date_rules(2016)
    assert {r.name for r in rules.rules if isinstance(r, TableRule)} == {"calendar.gap", *(f"{p}.wrong_length" for p in fixed.PERIOD_LABELS[:3])}
    for rule, change in CALENDAR_FAULTS.items():
        assert rules.report(change(good)).bad_rows(rule), rule
    with pytest.raises(ValueError, match="event_period"):
        checks.validate_dim_date_gold(good, study_year=2015)
    text = good.withColumn("date", F.col("date").cast("string"))
    checks.validate_dim_date_gold(text, study_year=2016)


# ----------------------------------------------------------- rules over two tables
def test_dim_product_against_silver(table):
    case = CASES["dim_product"]()
    native = table("product_id string, product_category_name string", (hexa(1), "pc gamer"), (hexa(2), "redes"))
    known = case.frame(table, ("a", {"category_en": None}), ("b", {})).drop("case_")
    assert checks.validate_product_gold(known, native) is known
    new = case.frame(table, ("a", {}), ("b", {"category_en": None})).drop("case_")
    with pytest.raises(ValueError, match="category_pt.untranslated .1 rows."):
        checks.validate_dim_product_gold(new, native)
    with pytest.raises(ValueError, match="table.wrong_size .1 rows."):
        checks.validate_dim_product_gold(known.limit(1), native)
    with pytest.raises(ValueError, match="table.empty"):
        checks.validate_dim_product_gold(known.limit(0), native)
    with pytest.raises(ValueError, match="missing required column"):
        checks.validate_dim_product_gold(known, native.drop("product_category_name"))


def test_fact_keys_have_to_exist(table):
    orders = CASES["fact_order"]().frame(table, ("a", {}))
    items, reviews = CASES["fact_order_item"](), CASES["fact_review"]()
    checks.validate_order_item_gold(items.frame(table, ("a", {})), orders)
    with pytest.raises(ValueError, match="order_keys.orphan"):
        checks.validate_fact_order_item_gold(items.frame(table, ("a", {"customer_key": 6})), orders)
    checks.validate_review_gold(reviews.frame(table, ("a", {"order_id": "ord-1"})), orders)
    with pytest.raises(ValueError, match="order_keys.orphan"):
        checks.validate_fact_review_gold(reviews.frame(table, ("a", {"order_id": "ord-1", "order_date_key": 1})), orders)


def test_fact_order_flag_has_to_be_boolean(table):
    df = CASES["fact_order"]().frame(table, ("a", {})).withColumn("is_new_at_order", F.lit("no"))
    with pytest.raises(ValueError, match="is_new_at_order is string"):
        checks.validate_fact_orders_gold(df)


def test_validators_accept_what_the_cleaners_give(table):
    raw = table(strings(fixed.REVIEW_COLUMNS), ("rev", "ord", "4", None, " fine ", MOON % 1, MOON % 2))
    assert checks.all_passed(checks.validate_reviews(silver.clean_reviews(raw)))
