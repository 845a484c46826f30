"""Raw tables to typed, tidy, accepted rows.

Every table has two halves: a *shape* function that casts and tidies columns, and an
acceptance `RuleSet`.  Cleaning is shape + accept; the rejected rows and the reasons
come from the same rules (`ACCEPTANCE[name]().split(shape(raw))`).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery import fixed
from orrery.functions import casting, measures, text
from orrery.operators.headers import (
    renamed,
    require_columns,
    standard_headers,
    without_bom,
)
from orrery.operators.rules import RowRule, RuleSet, UniqueRule, halves, must, one_of
from orrery.operators.survivors import distinct_rows, first_per_key
from orrery.plans import checks


# ------------------------------------------------------- customers and sellers
def _shape_party(df: DataFrame, ids: Sequence[str], prefix: str) -> DataFrame:
    zip_code, city, state = (
        f"{prefix}_zip_code_prefix", f"{prefix}_city", f"{prefix}_state",
    )
    return df.withColumns(
        {
            **{c: text.as_text(c) for c in ids},
            zip_code: casting.to_int(zip_code),
            city: text.lowered(city),
            state: text.uppered(state),
        }
    )


def _accept_party(dataset: str, ids: Sequence[str], prefix: str) -> RuleSet:
    zip_code = f"{prefix}_zip_code_prefix"
    present = [*ids, f"{prefix}_city", f"{prefix}_state"]
    return RuleSet(
        dataset,
        (*present, zip_code),
        [
            *(must(f"{c} is present", c, F.col(c).isNotNull()) for c in present),
            must("zip code in range", zip_code, F.col(zip_code).between(*fixed.ZIP_RANGE)),
        ],
    )


def shape_customers(df: DataFrame) -> DataFrame:
    return _shape_party(df, ["customer_id", "customer_unique_id"], "customer")


def customer_acceptance() -> RuleSet:
    return _accept_party("customers", ["customer_id", "customer_unique_id"], "customer")


def clean_customers(df: DataFrame) -> DataFrame:
    return customer_acceptance().accept(shape_customers(df))


def shape_sellers(df: DataFrame) -> DataFrame:
    return _shape_party(df, ["seller_id"], "seller")


def seller_acceptance() -> RuleSet:
    return _accept_party("sellers", ["seller_id"], "seller")


def clean_sellers(df: DataFrame) -> DataFrame:
    return seller_acceptance().accept(shape_sellers(df))


# ------------------------------------------------------------ orders and items
def clean_orders(df: DataFrame) -> DataFrame:
    """Timestamps and status; every row is kept, rules come later."""
    times = {c: casting.to_time(c) for c in fixed.ORDER_TIMES}
    return df.withColumns({**times, "order_status": text.lowered("order_status")})


def clean_order_items(df: DataFrame) -> DataFrame:
    """Types and stripped ids; every row is kept, rules come later."""
    return df.withColumns(
        {
            **{c: text.stripped(c) for c in ("order_id", "product_id", "seller_id")},
            "order_item_id": casting.to_int("order_item_id"),
            "shipping_limit_date": casting.to_time("shipping_limit_date"),
            "price": casting.to_double("price"),
            "freight_value": casting.to_double("freight_value"),
        }
    )


# ------------------------------------------------------------------- payments
_SOURCE_ORDER = "__source_order"


def _source_order(df: DataFrame, order_by: Sequence[str] | None) -> Column:
    """Where a row stands in its source: by the given columns, or by file and line.

    File names come first, then the start of the split, then the place in the split;
    how Spark packs splits into tasks has no part in it.
    """
    if order_by:
        return F.struct(*order_by).alias(_SOURCE_ORDER)
    position = F.struct(
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id().alias("row"),
    ).alias(_SOURCE_ORDER)
    try:
        df.select(position)
    except AnalysisException:
        raise ValueError(
            "the rows do not come straight from files: name their source order in order_by"
        ) from None
    return position


def shape_payments(df: DataFrame, *extra: Column) -> DataFrame:
    installments = casting.to_int("payment_installments")
    one_off_card = (text.lowered("payment_type") == "credit_card") & (installments == 0)
    shaped = {
        "order_id": text.lowered("order_id"),
        "payment_sequential": casting.to_int("payment_sequential"),
        "payment_type": text.lowered("payment_type"),
        "payment_installments": F.when(one_off_card, F.lit(1)).otherwise(installments),
        "payment_value": casting.to_double("payment_value"),
    }
    return df.select(*(column.alias(name) for name, column in shaped.items()), *extra)


def payment_acceptance(drop_not_defined: bool = False) -> RuleSet:
    types = [t for t in fixed.PAYMENT_TYPES if not (drop_not_defined and t == "not_defined")]
    col = F.col
    return RuleSet(
        "order_payments",
        fixed.PAYMENT_COLUMNS,
        [
            *(must(f"{c} is present", c, col(c).isNotNull()) for c in fixed.PAYMENT_COLUMNS),
            must("installments not negative", "payment_installments",
                 col("payment_installments") >= 0),
            must("sequence starts at one", "payment_sequential", col("payment_sequential") >= 1),
            must("value not negative", "payment_value", col("payment_value") >= 0),
            must("order id has full length", "order_id",
                 F.length("order_id") == fixed.ID_LENGTH),
            must("payment type is known", "payment_type", col("payment_type").isin(types)),
        ],
    )


def clean_order_payments(
    df: DataFrame,
    drop_not_defined: bool = False,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Accepted payments, the first one per (order_id, payment_sequential).

    `order_by` names columns that give the source order (a line number, a load time).
    Without it file and line count, for rows read from files and not shuffled since;
    other rows need `order_by`.
    """
    df = well_formed(df)
    position = _source_order(df, order_by).alias(_SOURCE_ORDER)
    df = require_columns(standard_headers(df.withColumn(_SOURCE_ORDER, position)), fixed.PAYMENT_COLUMNS, "order_payments")
    shaped = shape_payments(df, F.col(_SOURCE_ORDER))
    accepted = payment_acceptance(drop_not_defined).accept(shaped)
    survivors = first_per_key(accepted, ["order_id", "payment_sequential"], [_SOURCE_ORDER])
    return survivors.select(*fixed.PAYMENT_COLUMNS)


def aggregate_order_payment_totals(df: DataFrame) -> DataFrame:
    """Number of payments and their decimal total, per order."""
    df = require_columns(standard_headers(df), fixed.PAYMENT_COLUMNS, "order_payments")
    total = F.sum(casting.to_money("payment_value"))
    return df.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("payment_record_count"),
        total.alias("order_payment_total"),
    )


# ------------------------------------------------------------------- products
def normalise_category(name: str) -> Column:
    return text.category_key(name)


def clean_products(df: DataFrame) -> DataFrame:
    """Typed products without exact duplicates; conflicting rows stay for the rules."""
    source = {new: old for old, new in fixed.PRODUCT_RENAMES.items()}
    needed = [source.get(c, c) for c in fixed.PRODUCT_COLUMNS]
    df = require_columns(without_bom(df), needed, "products").select(*needed)
    shaped = renamed(df, fixed.PRODUCT_RENAMES).withColumns(
        {
            "product_id": text.blank_to_null("product_id"),
            "product_category_name": text.category_key("product_category_name"),
            **{c: casting.to_int(c) for c in fixed.PRODUCT_MEASURES},
        }
    )
    return distinct_rows(shaped)


# -------------------------------------------------------------------- reviews
_COMMENTS = {"review_comment_title": fixed.NO_TITLE, "review_comment_message": fixed.NO_MESSAGE}
_NEWEST_FIRST = ("review_answer_timestamp", "review_creation_date")


def standardise_reviews(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            **{c: text.blank_to_null(c) for c in ("review_id", "order_id")},
            **{c: text.one_line(text.blank_to_null(c)) for c in _COMMENTS},
            "review_score": casting.to_int("review_score"),
            **{c: casting.to_time(c, fixed.TIME_FORMAT) for c in _NEWEST_FIRST},
        }
    )


def review_acceptance() -> RuleSet:
    answered_later = F.col("review_answer_timestamp") >= F.col("review_creation_date")
    return RuleSet(
        "order_reviews",
        fixed.REVIEW_COLUMNS,
        [
            *(must(f"{c} is present", c, F.col(c).isNotNull()) for c in fixed.REVIEW_KEYS),
            must("score in range", "review_score",
                 F.col("review_score").between(*fixed.SCORE_RANGE)),
            must("answered after creation", "review_answer_timestamp", answered_later),
        ],
    )


def _review_stage(df: DataFrame, *columns: str, presence: bool) -> DataFrame:
    """Some of the acceptance rules of the reviews, as a stage of its own."""
    rules = review_acceptance()
    present = {f"{c} is present" for c in columns}
    chosen = [
        r for r in rules.rules
        if (r.name in present if presence else r.column in columns and r.name not in present)
    ]
    return replace(rules, rules=chosen).accept(df)


def drop_missing_key_fields(df: DataFrame) -> DataFrame:
    return _review_stage(df, *fixed.REVIEW_KEYS, presence=True)


def keep_valid_scores(df: DataFrame) -> DataFrame:
    return _review_stage(df, "review_score", presence=False)


def keep_valid_dates(df: DataFrame) -> DataFrame:
    return _review_stage(df, "review_answer_timestamp", presence=False)


def _newest_first() -> list[Column]:
    return [F.col(c).desc() for c in _NEWEST_FIRST]


def remove_duplicates(df: DataFrame) -> DataFrame:
    """The newest row per review and order; exact copies go by the same rule."""
    return first_per_key(df, ["review_id", "order_id"], _newest_first())


def latest_review_per_order(df: DataFrame) -> DataFrame:
    return first_per_key(df, ["order_id"], [*_newest_first(), F.col("review_id")])


def fill_missing_comments(df: DataFrame) -> DataFrame:
    flags = {c.replace("review", "has", 1): F.col(c).isNotNull() for c in _COMMENTS}
    return df.withColumns(flags).fillna(_COMMENTS)


def clean_reviews(df: DataFrame, one_review_per_order: bool = False) -> DataFrame:
    """Accepted reviews, newest per (review, order) or newest per order.

    The newest of an order is also the newest of its review, so either form needs
    exactly one exchange.
    """
    accepted = review_acceptance().accept(standardise_reviews(df))
    pick = latest_review_per_order if one_review_per_order else remove_duplicates
    return fill_missing_comments(pick(accepted))


# ----------------------------------------------------------------- categories
def sanitize_category_name(value: Column | str) -> Column:
    """Category key in which an empty or missing name reads `unknown`."""
    return text.category_key(value, blank=fixed.UNKNOWN_CATEGORY)


def clean_category_dataframe(
    df: DataFrame, order_by: Sequence[str] | None = None
) -> DataFrame:
    """One row per category key, first in source order; nothing is patched."""
    require_columns(df, fixed.CATEGORY_COLUMNS, "product_category")
    key, english = fixed.CATEGORY_COLUMNS
    shaped = df.select(
        sanitize_category_name(key).alias(key),
        text.title_letters(F.coalesce(text.as_text(english), F.lit(""))).alias(english),
        _source_order(df, order_by),
    )
    return first_per_key(shaped, [key], [_SOURCE_ORDER]).select(*fixed.CATEGORY_COLUMNS)


def clean_category_translation(df: DataFrame) -> DataFrame:
    """One row per category key; the fixed patch fills keys the source lacks."""
    key, english = fixed.CATEGORY_COLUMNS
    source = df.where(F.col(key).isNotNull()).select(
        text.separators_to_space(text.lowered(key)).alias(key),
        text.title_words(english).alias(english),
        F.lit(0).alias("__origin"),
    )
    patch = F.array(
        *(
            F.struct(F.lit(k).alias(key), F.lit(e).alias(english), F.lit(1).alias("__origin"))
            for k, e in fixed.CATEGORY_PATCH
        )
    )
    both = source.unionByName(df.sparkSession.range(1).select(F.inline(patch)))
    survivors = first_per_key(both, [key], ["__origin", F.col(english).asc_nulls_last()])
    return survivors.select(*fixed.CATEGORY_COLUMNS)


# -------------------------------------------------------- rejected rows by table
SHAPES: dict[str, tuple[Callable[[DataFrame], DataFrame], Callable[[], RuleSet]]] = {
    "customers": (shape_customers, customer_acceptance),
    "sellers": (shape_sellers, seller_acceptance),
    "orders": (clean_orders, checks.order_rules),
    "order_items": (clean_order_items, checks.order_item_rules),
    "products": (clean_products, checks.product_rules),
    "order_payments": (shape_payments, payment_acceptance),
    "order_reviews": (standardise_reviews, review_acceptance),
}


def quarantine_rules(dataset: str) -> RuleSet:
    """What a row has to meet to reach Gold: acceptance, and a known state for parties."""
    rules = SHAPES[dataset][1]()
    if dataset not in ("customers", "sellers"):
        return rules
    state = f"{dataset.removesuffix('s')}_state"
    return replace(rules, rules=[*rules.rules, one_of(state, fixed.STATE_CODES, f"{state}.unknown")])


#: The column in which a CSV reader leaves lines that it cannot place, where it is asked to.
MALFORMED_LINE = "malformed_line"


def well_formed(raw: DataFrame) -> DataFrame:
    """The rows that a reader could place, without the column of those that it could not."""
    if MALFORMED_LINE not in raw.columns:
        return raw
    return raw.where(F.col(MALFORMED_LINE).isNull()).drop(MALFORMED_LINE)


def _malformed(raw: DataFrame) -> DataFrame:
    """One entry (column_name, rule, invalid_value) for each line that has no place."""
    return raw.where(F.col(MALFORMED_LINE).isNotNull()).select(
        F.lit("line").alias("column_name"),
        F.lit("line is well formed").alias("rule"),
        F.col(MALFORMED_LINE).alias("invalid_value"),
    )


def quarantine(dataset: str, raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows of one raw table, before duplicates are dropped."""
    return halves(judged(dataset, raw))


def judged(dataset: str, raw: DataFrame) -> DataFrame:
    """The rows of one raw table with `broken_rules`, which is empty for accepted ones.

    Lines that the reader could not place (see `MALFORMED_LINE`) are rejected whole: their
    columns are null, as nothing says which field is which, and the reason holds the line.
    """
    rows = quarantine_rules(dataset).annotate(SHAPES[dataset][0](standard_headers(well_formed(raw))))
    if MALFORMED_LINE in raw.columns:
        whole = _malformed(raw).select(F.array(F.struct("*")).alias("broken_rules"))
        rows = rows.unionByName(whole, allowMissingColumns=True)
    return rows


def rejected_values(dataset: str, raw: DataFrame) -> DataFrame:
    """The log rows of `quarantine`: one per broken acceptance rule, one per malformed line."""
    shape, rules = SHAPES[dataset]
    found = rules().invalid_rows(shape(standard_headers(well_formed(raw))))
    if MALFORMED_LINE not in raw.columns:
        return found
    return found.unionByName(_malformed(raw).select(F.lit(rules().dataset).alias("dataset"), "*"))


# Keys by which rows of a table are counted: those of its key rule or its survivors.
_TALLY_KEYS = {
    "orders": ("order_id",),
    "order_items": ("order_id", "order_item_id"),
    "order_payments": ("order_id", "payment_sequential"),
    "order_reviews": ("review_id", "order_id"),
}


def tally(dataset: str, raw: DataFrame) -> DataFrame:
    """One row (silver_before, silver_after, invalid_rows) from one scan of the raw table.

    Rows are counted, not broken rules.  Tables with a key are folded to it inside the
    tasks first.  Only products are read twice: their exact copies go before the rules.
    Malformed lines are counted by a scan of their own: they came in and are invalid.
    """
    counted = _tally(dataset, well_formed(raw))
    if MALFORMED_LINE not in raw.columns:
        return counted
    lines, none = F.count(MALFORMED_LINE), F.lit(0).cast("bigint")
    both = counted.unionByName(raw.agg(*_tallied(lines, none, lines)))
    return both.agg(*(F.sum(c).alias(c) for c in counted.columns))


def _tally(dataset: str, raw: DataFrame) -> DataFrame:
    shape, rule_set = SHAPES[dataset]
    rules = rule_set()
    shaped = shape(standard_headers(raw))
    broken = reduce(
        or_, (measures.is_true(r.bad) for r in rules.rules if isinstance(r, RowRule))
    )
    rows, bad = F.sum("n"), F.sum("bad")
    if dataset in ("customers", "sellers"):
        counted = shaped.agg(F.count(F.lit(1)).alias("n"), F.count_if(broken).alias("bad"))
        return counted.select(*_tallied(F.col("n"), F.col("n") - F.col("bad"), F.col("bad")))
    keys = _TALLY_KEYS.get(dataset, ("product_id",))
    folded = shaped.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(broken).alias("bad")
    )
    if dataset in ("order_payments", "order_reviews"):
        # One row of each key survives, if any row of it is accepted.
        return folded.agg(*_tallied(rows, F.count_if(F.col("bad") < F.col("n")), bad))
    unique = next(r for r in rules.rules if isinstance(r, UniqueRule))
    repeated = F.col("n") > 1
    if unique.skip_null:
        repeated = repeated & F.col(keys[0]).isNotNull()
    invalid = F.sum(F.when(repeated, F.col("n")).otherwise(F.col("bad")))
    after = folded.agg(*_tallied(rows, rows, invalid))
    if dataset != "products":
        return after
    zero = F.lit(0).cast("bigint")
    before = raw.agg(F.count(F.lit(1)).alias("silver_before"))
    both = after.withColumn("silver_before", zero).unionByName(
        before.withColumns({"silver_after": zero, "invalid_rows": zero})
    )
    return both.agg(*(F.sum(c).alias(c) for c in after.columns))


def _tallied(before: Column, after: Column, invalid: Column) -> list[Column]:
    return [
        F.coalesce(c, F.lit(0)).cast("bigint").alias(name)
        for c, name in ((before, "silver_before"), (after, "silver_after"), (invalid, "invalid_rows"))
    ]
