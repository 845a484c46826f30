"""Dimension builders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery import fixed
from orrery.functions import casting, text
from orrery.functions.days import black_friday, calendar_attributes
from orrery.operators.headers import renamed
from orrery.operators.keys import dense_key, kept_keys
from orrery.operators.medians import median_per_key
from orrery.operators.survivors import first_per_key


# ------------------------------------------------------------------- calendar
def add_date_attributes(df: DataFrame, study_year: int = fixed.STUDY_YEAR) -> DataFrame:
    """The twelve calendar columns, each derived from the column `date`."""
    attributes = calendar_attributes(F.col("date"), study_year)
    return df.select(*(column.alias(name) for name, column in attributes.items()))


def _days(bounds: DataFrame) -> DataFrame:
    """One row per day from `first` to `last` of a one-row frame."""
    return bounds.select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date")
    )


def build_dim_date(
    source: SparkSession | DataFrame,
    start_date: str = fixed.CALENDAR_START,
    end_date: str = fixed.CALENDAR_END,
    study_year: int = fixed.STUDY_YEAR,
) -> DataFrame:
    """One row per day between two fixed dates; `source` only lends its session."""
    spark = getattr(source, "sparkSession", source)
    bounds = spark.range(1).select(
        F.lit(start_date).cast("date").alias("first"), F.lit(end_date).cast("date").alias("last")
    )
    return add_date_attributes(_days(bounds), study_year)


def build_dim_date_covering(
    df: DataFrame, column: str, study_year: int = fixed.STUDY_YEAR
) -> DataFrame:
    """Whole years that cover every value of a date or time column.

    The bounds stay inside the plan: one min/max aggregate feeds the generator.
    """
    day = casting.to_day(column)
    bounds = df.agg(F.min(day).alias("low"), F.max(day).alias("high")).select(
        F.make_date(F.year("low"), F.lit(1), F.lit(1)).alias("first"),
        F.make_date(F.year("high"), F.lit(12), F.lit(31)).alias("last"),
    )
    return add_date_attributes(_days(bounds), study_year)


def period_report(dim_date: DataFrame) -> DataFrame:
    """Days per study period, in report order."""
    columns = ["period_group_sort", "period_group", "event_period_sort", "event_period"]
    return dim_date.groupBy(*columns).count().orderBy("event_period_sort")


# ----------------------------------------------------------------------- keys
def _keyed(
    df: DataFrame, natural_key: str, name: str, key_table: str | None, **key_options
) -> DataFrame:
    """`df` with a surrogate key: 1..N in this load, or the one kept in `key_table`."""
    if key_table is None:
        return dense_key(df, natural_key, name, **key_options)
    options = {k: v for k, v in key_options.items() if k != "tie_breakers"}
    return kept_keys(df, natural_key, name, key_table, **options)


# ------------------------------------------------------------------ customers
def clean_customers_gold(df: DataFrame) -> DataFrame:
    """Customers with an id and a first purchase that is not in the future."""
    first = casting.to_time("customer_first_purchase_date")
    return df.where(F.col("customer_id").isNotNull() & (first <= F.current_timestamp())).withColumns(
        {
            "customer_city": text.lowered("customer_city"),
            "customer_state": text.uppered("customer_state"),
        }
    )


def customer_people(customers: DataFrame) -> DataFrame:
    """customer_id -> customer_unique_id, one row per customer_id."""
    return first_per_key(
        customers.select("customer_id", "customer_unique_id"), ["customer_id"]
    )


def build_dim_customer(
    customers: DataFrame,
    orders: DataFrame,
    customer_ids_unique: bool = False,
    key_table: str | None = None,
    **key_options,
) -> DataFrame:
    """One keyed row per person, described by the person's lowest customer_id.

    `customer_ids_unique` saves an exchange where the Silver rules have already
    shown that customer_id is unique; `key_options` go to `dense_key`.  With `key_table`
    persons keep the keys that this table holds, and new ones are added to it.
    """
    people = customers.select(
        "customer_id", "customer_unique_id", "customer_state", "customer_city"
    )
    if not customer_ids_unique:
        people = first_per_key(people, ["customer_id"])
    known = people.where(F.col("customer_unique_id").isNotNull())

    # Fold orders to one day per customer_id before the join: a customer with a
    # third of all orders is one row per task here.
    first_by_id = orders.groupBy("customer_id").agg(
        F.min(casting.to_day("order_purchase_timestamp")).alias("first_order_date")
    )
    # One grouping finds the first order and the lowest customer_id of each person.
    described = F.struct(
        "customer_id",
        text.uppered("customer_state").alias("state"),
        text.lowered("customer_city").alias("city"),
    )
    persons = (
        known.join(first_by_id, "customer_id", "left")
        .groupBy("customer_unique_id")
        .agg(
            F.min("first_order_date").alias("first_order_date"),
            F.min(described).alias("lowest"),
        )
        .select("customer_unique_id", "first_order_date", "lowest.state", "lowest.city")
    )
    keyed = _keyed(
        persons, "customer_unique_id", "customer_key", key_table,
        **{"size_from": known, **key_options},
    )
    return keyed.select(*fixed.DIM_CUSTOMER_COLUMNS)


# ------------------------------------------------------------------- products
def format_english(name: str):
    return text.display_text(name)


def add_category_english(products: DataFrame, translation: DataFrame) -> DataFrame:
    """English names by category key; a repeated key cannot multiply products.

    No broadcast hint: the translation list is small, and Spark broadcasts it after
    looking at its size.
    """
    key, english = fixed.CATEGORY_COLUMNS
    names = translation.select(key, text.display_text(english).alias(english))
    one_name = first_per_key(names, [key], [F.col(english).asc_nulls_last()])
    return products.join(one_name, key, "left")


def event_days(study_year: int = fixed.STUDY_YEAR):
    """First and last day of the event, as constant Columns."""
    first = black_friday(F.lit(study_year))
    return first, F.date_add(first, fixed.EVENT_DAYS - 1)


def compute_baseline_price(
    items: DataFrame, orders: DataFrame, study_year: int = fixed.STUDY_YEAR, **median_options
) -> DataFrame:
    """Exact median price per product, without the event days and unsold orders."""
    day = casting.to_day("order_purchase_timestamp")
    counted = orders.where(
        ~F.col("order_status").isin(*fixed.NO_SALE_STATUSES)
        & ~day.between(*event_days(study_year))
    ).select("order_id")
    prices = items.select("order_id", "product_id", casting.to_double("price").alias("price"))
    medians = median_per_key(
        prices.join(counted, "order_id"),
        "product_id",
        "price",
        "median",
        size_from=items.select(casting.to_double("price").alias("price")),
        **median_options,
    )
    return medians.select("product_id", F.round("median", 2).alias("baseline_price_med"))


def build_dim_product_gold(
    products: DataFrame,
    translation: DataFrame,
    items: DataFrame,
    orders: DataFrame,
    study_year: int = fixed.STUDY_YEAR,
    key_table: str | None = None,
    **key_options,
) -> DataFrame:
    """Every product, keyed, with its English category and its baseline price.

    Keys are given to the narrow product rows before anything is joined.
    `key_options` go to `dense_key`; pass `size_from` where counting `products` means
    computing them.  With `key_table` products keep the keys that this table holds;
    rows of one product_id then share a key, so the rules have to show that there are none.
    """
    measures = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
    columns = ["product_id", "product_category_name", *measures]
    keyed = _keyed(
        products.select(*columns), "product_id", "product_key", key_table,
        tie_breakers=columns[1:], **key_options,
    )
    short = {m: m.removeprefix("product_") for m in measures}
    names = dict(zip(fixed.CATEGORY_COLUMNS, ("category_pt", "category_en")))
    baseline = compute_baseline_price(items, orders, study_year)
    return renamed(
        add_category_english(keyed, translation).join(baseline, "product_id", "left"),
        {**short, **names},
    ).select(*fixed.DIM_PRODUCT_COLUMNS)


build_dim_product = build_dim_product_gold


# -------------------------------------------------------------------- sellers
def clean_dim_seller_gold(
    df: DataFrame, key_table: str | None = None, **key_options
) -> DataFrame:
    """Keyed sellers with an id and a zip code in range.

    With `key_table` sellers keep the keys that this table holds, and new ones are added to it.
    """
    accepted = df.where(
        F.col("seller_id").isNotNull()
        & F.col("seller_zip_code_prefix").between(*fixed.ZIP_RANGE)
    ).select(
        "seller_id",
        text.uppered("seller_state").alias("seller_state"),
        text.lowered("seller_city").alias("seller_city"),
    )
    keyed = _keyed(
        accepted, "seller_id", "seller_key", key_table,
        tie_breakers=["seller_state", "seller_city"], **key_options,
    )
    return keyed.select(*fixed.DIM_SELLER_COLUMNS)


clean_sellers_gold = clean_dim_seller_gold
