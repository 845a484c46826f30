"""Raw inputs of the e-commerce model, derived from the generic trade tables.

The trade tables (orders, lineitem, customer, ...) are clean; the raw inputs are
not.  Fixed shares of the rows get padding, odd case, unparseable numbers, missing
keys, repeated rows and so on, chosen by key modulo, so that every cleaning and
validation rule has something to find.  All of it is row-by-row projection: work
grows with the tables and nothing but two lookups is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery import fixed

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


# Declared, so that opening a table needs no job to look at its files.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def trade_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


# -------------------------------------------------------------------- helpers
# Kind of id -> letter that fills the number up to 32 hex digits.
ORDER, PERSON, PRODUCT, SELLER, REVIEW, MISSING = "a", "b", "c", "d", "e", "f"


def _id(kind: str, key: str | Column) -> Column:
    """A 32-digit lower-case hex id that is cheap to make: 17 -> 17aaaa..."""
    number = (F.col(key) if isinstance(key, str) else key).cast("string")
    return F.rpad(number, fixed.ID_LENGTH, kind)


def _every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def _cases(*cases: tuple[Column, Column | None], otherwise: Column) -> Column:
    """First matching case; None stands for NULL."""
    result = otherwise
    for condition, value in reversed(cases):
        result = F.when(condition, F.lit(None) if value is None else value).otherwise(result)
    return result


def _clock(moment: Column) -> Column:
    """yyyy-MM-dd HH:mm:ss, without the detour through a time zone."""
    return F.substring(moment.cast("string"), 1, 19)


def _plus(moment: Column, days: Column | int = 0, hours: Column | int = 0) -> Column:
    as_int = [F.lit(v).cast("int") if isinstance(v, int) else v.cast("int") for v in (days, hours)]
    return moment + F.make_dt_interval(*as_int)


def _copies(**when: Column) -> Column:
    """Array of copy numbers: 0 always, 1.. for each condition that holds."""
    extra = [F.when(c, F.lit(i)) for i, c in enumerate(when.values(), 1)]
    return F.explode(F.array_compact(F.array(F.lit(0), *extra)))


def _zip_code(key: str) -> Column:
    digits = (F.col(key) * 7919 % 101000).cast("string")
    return _cases((_every(key, 97) & (F.col(key) > 0), F.lit("n/a")), otherwise=digits)


def _state(nation: str, key: str) -> Column:
    codes = F.array(*(F.lit(" " + code.lower()) for code in fixed.STATE_CODES))
    code = F.get(codes, F.col(nation) % len(fixed.STATE_CODES))
    return _cases((_every(key, 83), F.lit("xx")), otherwise=code)


def _city() -> Column:
    return F.concat(F.lit("  "), F.col("n_name"), F.lit(" "))


# ----------------------------------------------------------------- raw tables
def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    """One customer_id per order; many of them belong to the same person."""
    orders = trade_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customer = trade_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nation = trade_table(spark, folder, "nation").select("n_nationkey", "n_name")
    joined = orders.join(
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")),
        F.col("o_custkey") == F.col("c_custkey"),
    )
    return joined.select(
        _cases((_every("o_orderkey", 499), None), otherwise=_id(ORDER, "o_orderkey")).alias("customer_id"),
        _cases((_every("o_orderkey", 503), None), otherwise=_id(PERSON, "c_custkey")).alias("customer_unique_id"),
        _zip_code("c_custkey").alias("customer_zip_code_prefix"),
        _cases((_every("o_orderkey", 509), None), otherwise=_city()).alias("customer_city"),
        _state("c_nationkey", "c_custkey").alias("customer_state"),
    )


def raw_sellers(spark: SparkSession, folder: str) -> DataFrame:
    supplier = trade_table(spark, folder, "supplier")
    nation = trade_table(spark, folder, "nation")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        _id(SELLER, "s_suppkey").alias("seller_id"),
        _zip_code("s_suppkey").alias("seller_zip_code_prefix"),
        _city().alias("seller_city"),
        _state("s_nationkey", "s_suppkey").alias("seller_state"),
    )


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    bought = _plus(F.col("o_orderdate"), hours=key % 24)
    state = _cases(
        (_every("o_orderkey", 701), F.lit("deliverd")),
        (_every("o_orderkey", 53), F.lit("Unavailable")),
        (status == "F", F.lit("  Delivered ")),
        (status == "O", F.lit("SHIPPED")),
        otherwise=F.lit("canceled"),
    )
    approved = _cases(
        (_every("o_orderkey", 13), None),
        (_every("o_orderkey", 401), F.lit("not a date")),
        (_every("o_orderkey", 307), _clock(_plus(bought, hours=-1))),
        otherwise=_clock(_plus(bought, hours=key % 48)),
    )
    carrier = _cases(
        (_every("o_orderkey", 311), _plus(bought, days=-1)),
        (status == "P", None),
        otherwise=_plus(bought, days=2),
    )
    delivered = F.when(status == "F", _plus(bought, days=3 + key % 20))
    return trade_table(spark, folder, "orders").select(
        _id(ORDER, "o_orderkey").alias("order_id"),
        _cases((_every("o_orderkey", 521), None), otherwise=_id(ORDER, "o_orderkey")).alias("customer_id"),
        state.alias("order_status"),
        bought.alias("order_purchase_timestamp"),
        approved.alias("order_approved_at"),
        carrier.alias("order_delivered_carrier_date"),
        delivered.alias("order_delivered_customer_date"),
        _plus(F.col("o_orderdate"), days=12).alias("order_estimated_delivery_date"),
    )


def raw_order_items(spark: SparkSession, folder: str) -> DataFrame:
    """Line numbers repeat within an order here and there; that is left as it is."""
    price = F.col("l_extendedprice")
    order_id = _id(ORDER, "l_orderkey")
    return trade_table(spark, folder, "lineitem").select(
        _cases(
            (_every("l_orderkey", 613) & (F.col("l_linenumber") == 1), None),
            (_every("l_orderkey", 7), F.concat(F.lit(" "), order_id, F.lit(" "))),
            otherwise=order_id,
        ).alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        _id(PRODUCT, "l_partkey").alias("product_id"),
        _id(SELLER, "l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        _cases((_every("l_orderkey", 617), -price), otherwise=price).alias("price"),
        _cases(
            (_every("l_orderkey", 619), F.lit(-1.0)),
            otherwise=F.col("l_quantity") * 0.25,
        ).alias("freight_value"),
    )


def raw_order_payments(spark: SparkSession, folder: str) -> DataFrame:
    """One payment per order, a voucher for some, a conflicting copy for others."""
    key, copy = F.col("o_orderkey"), F.col("copy")
    first = copy == 0
    rows = trade_table(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderpriority",
        _copies(voucher=_every("o_orderkey", 3), conflict=_every("o_orderkey", 7)).alias("copy"),
    )
    order_id = _id(ORDER, "o_orderkey")
    payment_type = _cases(
        (copy == 1, F.lit(" Voucher ")),
        (copy == 2, F.lit("boleto")),
        (_every("o_orderkey", 89), F.lit("bitcoin")),
        (F.col("o_orderpriority") == "1-URGENT", F.lit(" CREDIT_CARD")),
        (F.col("o_orderpriority") == "2-HIGH", F.lit("boleto")),
        (F.col("o_orderpriority") == "3-MEDIUM", F.lit("voucher")),
        (F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("not_defined")),
        otherwise=F.lit("debit_card "),
    )
    return rows.select(
        _cases(
            (first & _every("o_orderkey", 109), None),
            (first & _every("o_orderkey", 113), F.substring(order_id, 1, 9)),
            (copy == 2, F.upper(order_id)),
            otherwise=order_id,
        ).alias("order_id"),
        _cases(
            (copy == 1, F.lit("2")),
            (first & _every("o_orderkey", 107), F.lit("0")),
            otherwise=F.lit("1"),
        ).alias("payment_sequential"),
        payment_type.alias("payment_type"),
        _cases(
            (copy > 0, copy.cast("string")),
            (_every("o_orderkey", 91), F.lit("-1")),
            otherwise=(key % 4).cast("string"),
        ).alias("payment_installments"),
        _cases(
            (copy == 1, F.lit("5.50")),
            (copy == 2, F.lit("99.0")),
            (_every("o_orderkey", 97), F.lit("abc")),
            (_every("o_orderkey", 101), F.lit("-5.0")),
            (_every("o_orderkey", 103), F.lit("0.0")),
            otherwise=F.col("o_totalprice").cast("decimal(18,2)").cast("string"),
        ).alias("payment_value"),
        (key * 4 + copy).alias("source_row"),
    )


def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    """Some parts come twice: as an exact copy, or with another weight."""
    copy, size = F.col("copy"), F.col("p_size")
    rows = trade_table(spark, folder, "part").select(
        "p_partkey", "p_name", "p_size",
        _copies(exact=_every("p_partkey", 11), conflict=_every("p_partkey", 13)).alias("copy"),
    )
    product_id = _id(PRODUCT, "p_partkey")

    def number(value: Column, *cases: tuple[int, str]) -> Column:
        odd = [(_every("p_partkey", n), F.lit(shown)) for n, shown in cases]
        return _cases(*odd, otherwise=value.cast("string"))

    return rows.select(
        _cases(
            (_every("p_partkey", 149), F.upper(product_id)),
            (_every("p_partkey", 151), F.lit("   ")),
            (_every("p_partkey", 5), F.concat(F.lit(" "), product_id)),
            otherwise=product_id,
        ).alias("product_id"),
        _cases(
            (_every("p_partkey", 71), None),
            (_every("p_partkey", 73), F.lit("  ")),
            (_every("p_partkey", 79), F.lit("PC_Gamer")),
            (_every("p_partkey", 3), F.upper(F.replace("p_name", F.lit(" "), F.lit("__-")))),
            otherwise=F.replace("p_name", F.lit(" "), F.lit("_")),
        ).alias("product_category_name"),
        number(F.length("p_name")).alias("product_name_lenght"),
        number(size * 10).alias("product_description_lenght"),
        number(1 + size % 6, (157, "0")).alias("product_photos_qty"),
        number(
            size * 50 + F.when(copy == 2, 1).otherwise(0), (163, "abc"), (167, "-1")
        ).alias("product_weight_g"),
        number(size + 5, (173, "0")).alias("product_length_cm"),
        number(size + 2).alias("product_height_cm"),
        number(size + 3).alias("product_width_cm"),
    )


def raw_category_translation(spark: SparkSession, folder: str) -> DataFrame:
    """Category names of the parts with an English form; two names have none."""
    names = trade_table(spark, folder, "part").select("p_name").distinct()
    return names.where(~F.col("p_name").isin("small ring", "red widget")).select(
        _cases(
            (F.col("p_name") == "old anvil", None),
            otherwise=F.replace("p_name", F.lit(" "), F.lit("_")),
        ).alias("product_category_name"),
        _cases(
            (F.col("p_name").startswith("hot"), F.replace("p_name", F.lit(" "), F.lit("_"))),
            otherwise=F.concat(F.lit(" "), F.upper("p_name")),
        ).alias("product_category_name_english"),
    )


def raw_order_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Events as reviews; documents, as long as they are, as their comments."""
    key, copy = F.col("event_id"), F.col("copy")
    events = trade_table(spark, folder, "events").select("event_id", "ts", "event_type", "value")
    comments = trade_table(spark, folder, "documents").select("doc_id", "text")
    rows = events.join(comments, F.col("event_id") == F.col("doc_id"), "left").withColumn(
        "copy", _copies(later=_every("event_id", 17))
    )
    ordered = F.floor(key / 2) * 3
    return rows.select(
        _cases(
            (_every("event_id", 197), F.lit("  ")),
            otherwise=F.concat(F.lit(" "), _id(REVIEW, "event_id")),
        ).alias("review_id"),
        _cases(
            (_every("event_id", 331), _id(MISSING, "event_id")), otherwise=_id(ORDER, ordered)
        ).alias("order_id"),
        _cases(
            (_every("event_id", 211), F.lit("x")),
            (_every("event_id", 227), F.lit("0")),
            otherwise=(1 + F.floor(F.col("value") / 25)).cast("string"),
        ).alias("review_score"),
        _cases(
            (_every("event_id", 5), None),
            (_every("event_id", 7), F.lit("   ")),
            otherwise=F.concat(F.lit(" "), F.col("event_type")),
        ).alias("review_comment_title"),
        F.col("text").alias("review_comment_message"),
        _cases((_every("event_id", 223), F.lit("soon")), otherwise=_clock(F.col("ts"))).alias(
            "review_creation_date"
        ),
        _clock(_plus(F.col("ts"), days=copy, hours=key % 50 - 3)).alias("review_answer_timestamp"),
    )
