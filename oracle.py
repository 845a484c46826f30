"""The queries of the registry, written independently as DuckDB SQL.

`TABLES` holds named subqueries, each in terms of the trade tables or of earlier
ones; a statement is one of them, or a SELECT over them, with the WITH clause that
it needs.
"""

from __future__ import annotations

import re

from orrery.sources.spoiled import NUMBER, SPOILS

# Fixed values, as in orrery/fixed.py.
STATES = (
    "['AC','AL','AM','AP','BA','CE','DF','ES','GO','MA','MG','MS','MT','PA',"
    "'PB','PE','PI','PR','RJ','RN','RO','RR','RS','SC','SE','SP','TO']"
)
STATE_LIST = STATES[1:-1]
STATUSES = (
    "'approved','canceled','created','delivered',"
    "'invoiced','processing','shipped','unavailable'"
)
TYPES = "'boleto','credit_card','debit_card','not_defined','voucher'"
CLOCK = "%Y-%m-%d %H:%M:%S"


def _zip(key: str) -> str:
    return (
        f"CASE WHEN {key} % 97 = 0 AND {key} > 0 THEN 'n/a' "
        f"ELSE CAST(({key} * 7919) % 101000 AS VARCHAR) END"
    )


def _state(nation: str, key: str) -> str:
    return (
        f"CASE WHEN {key} % 83 = 0 THEN 'xx' "
        f"ELSE ' ' || lower({STATES}[{nation} % 27 + 1]) END"
    )


def _int(text: str) -> str:
    """Only whole numbers count as integers."""
    return (
        f"CASE WHEN regexp_full_match(trim(CAST({text} AS VARCHAR)), '[+-]?[0-9]+') "
        f"THEN TRY_CAST({text} AS INTEGER) END"
    )


def _title(text: str) -> str:
    """Capital after each space."""
    return (
        f"list_aggregate(list_transform(string_split(lower(trim({text})), ' '), "
        "lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ')"
    )


def _title_letters(text: str) -> str:
    """Capital after anything that is not a letter."""
    return (
        f"coalesce(list_aggregate(list_transform(regexp_extract_all(trim({text}), "
        "'([A-Za-z]+|[^A-Za-z]+)'), lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ''), '')"
    )


def _display(text: str) -> str:
    return f"nullif(trim(regexp_replace(lower({text}), '[_\\-\\s]+', ' ', 'g')), '')"


def _copies(*conditions: str) -> str:
    extra = ", ".join(f"CASE WHEN {c} THEN {i} END" for i, c in enumerate(conditions, 1))
    return f"unnest(list_filter([0, {extra}], lambda x: x IS NOT NULL))"


TABLES: dict[str, str] = {}

# ------------------------------------------------------------------ raw inputs
TABLES["raw_customers"] = f"""
SELECT CASE WHEN o_orderkey % 499 = 0 THEN NULL ELSE rpad(CAST(o_orderkey AS VARCHAR), 32, 'a') END AS customer_id,
       CASE WHEN o_orderkey % 503 = 0 THEN NULL ELSE rpad(CAST(c_custkey AS VARCHAR), 32, 'b') END AS customer_unique_id,
       {_zip('c_custkey')} AS customer_zip_code_prefix,
       CASE WHEN o_orderkey % 509 = 0 THEN NULL ELSE '  ' || n_name || ' ' END AS customer_city,
       {_state('c_nationkey', 'c_custkey')} AS customer_state
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""

TABLES["raw_sellers"] = f"""
SELECT rpad(CAST(s_suppkey AS VARCHAR), 32, 'd') AS seller_id, {_zip('s_suppkey')} AS seller_zip_code_prefix,
       '  ' || n_name || ' ' AS seller_city, {_state('s_nationkey', 's_suppkey')} AS seller_state
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

TABLES["raw_orders"] = f"""
SELECT rpad(CAST(k AS VARCHAR), 32, 'a') AS order_id,
       CASE WHEN k % 521 = 0 THEN NULL ELSE rpad(CAST(k AS VARCHAR), 32, 'a') END AS customer_id,
       CASE WHEN k % 701 = 0 THEN 'deliverd' WHEN k % 53 = 0 THEN 'Unavailable'
            WHEN s = 'F' THEN '  Delivered ' WHEN s = 'O' THEN 'SHIPPED' ELSE 'canceled' END AS order_status,
       b AS order_purchase_timestamp,
       CASE WHEN k % 13 = 0 THEN NULL WHEN k % 401 = 0 THEN 'not a date'
            WHEN k % 307 = 0 THEN strftime(b - INTERVAL 1 HOUR, '{CLOCK}')
            ELSE strftime(b + to_hours(k % 48), '{CLOCK}') END AS order_approved_at,
       CASE WHEN k % 311 = 0 THEN b - INTERVAL 1 DAY WHEN s = 'P' THEN NULL
            ELSE b + INTERVAL 2 DAY END AS order_delivered_carrier_date,
       CASE WHEN s = 'F' THEN b + to_days(CAST(3 + k % 20 AS INTEGER)) END
            AS order_delivered_customer_date,
       d + INTERVAL 12 DAY AS order_estimated_delivery_date
FROM (SELECT o_orderkey AS k, o_orderstatus AS s, CAST(o_orderdate AS TIMESTAMP) AS d,
             CAST(o_orderdate AS TIMESTAMP) + to_hours(o_orderkey % 24) AS b FROM orders)"""

TABLES["raw_order_items"] = f"""
SELECT CASE WHEN l_orderkey % 613 = 0 AND l_linenumber = 1 THEN NULL
            WHEN l_orderkey % 7 = 0 THEN ' ' || rpad(CAST(l_orderkey AS VARCHAR), 32, 'a') || ' '
            ELSE rpad(CAST(l_orderkey AS VARCHAR), 32, 'a') END AS order_id,
       l_linenumber AS order_item_id, rpad(CAST(l_partkey AS VARCHAR), 32, 'c') AS product_id,
       rpad(CAST(l_suppkey AS VARCHAR), 32, 'd') AS seller_id,
       CAST(l_shipdate AS TIMESTAMP) AS shipping_limit_date,
       CASE WHEN l_orderkey % 617 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS price,
       CASE WHEN l_orderkey % 619 = 0 THEN CAST(-1.0 AS DOUBLE)
            ELSE l_quantity * CAST(0.25 AS DOUBLE) END AS freight_value
FROM lineitem"""

TABLES["raw_order_payments"] = f"""
SELECT CASE WHEN c = 0 AND k % 109 = 0 THEN NULL WHEN c = 0 AND k % 113 = 0 THEN left(id, 9)
            WHEN c = 2 THEN upper(id) ELSE id END AS order_id,
       CASE WHEN c = 1 THEN '2' WHEN c = 0 AND k % 107 = 0 THEN '0' ELSE '1' END AS payment_sequential,
       CASE WHEN c = 1 THEN ' Voucher ' WHEN c = 2 THEN 'boleto' WHEN k % 89 = 0 THEN 'bitcoin'
            WHEN p = '1-URGENT' THEN ' CREDIT_CARD' WHEN p = '2-HIGH' THEN 'boleto'
            WHEN p = '3-MEDIUM' THEN 'voucher' WHEN p = '4-NOT SPECIFIED' THEN 'not_defined'
            ELSE 'debit_card ' END AS payment_type,
       CASE WHEN c > 0 THEN CAST(c AS VARCHAR) WHEN k % 91 = 0 THEN '-1'
            ELSE CAST(k % 4 AS VARCHAR) END AS payment_installments,
       CASE WHEN c = 1 THEN '5.50' WHEN c = 2 THEN '99.0' WHEN k % 97 = 0 THEN 'abc'
            WHEN k % 101 = 0 THEN '-5.0' WHEN k % 103 = 0 THEN '0.0'
            ELSE CAST(CAST(v AS DECIMAL(18,2)) AS VARCHAR) END AS payment_value,
       k * 4 + c AS source_row
FROM (SELECT o_orderkey AS k, rpad(CAST(o_orderkey AS VARCHAR), 32, 'a') AS id, o_totalprice AS v,
             o_orderpriority AS p, {_copies('o_orderkey % 3 = 0', 'o_orderkey % 7 = 0')} AS c
      FROM orders)"""

TABLES["raw_products"] = f"""
SELECT CASE WHEN k % 149 = 0 THEN upper(id) WHEN k % 151 = 0 THEN '   '
            WHEN k % 5 = 0 THEN ' ' || id ELSE id END AS product_id,
       CASE WHEN k % 71 = 0 THEN NULL WHEN k % 73 = 0 THEN '  ' WHEN k % 79 = 0 THEN 'PC_Gamer'
            WHEN k % 3 = 0 THEN upper(replace(n, ' ', '__-')) ELSE replace(n, ' ', '_') END
            AS product_category_name,
       CAST(length(n) AS VARCHAR) AS product_name_lenght,
       CAST(z * 10 AS VARCHAR) AS product_description_lenght,
       CASE WHEN k % 157 = 0 THEN '0' ELSE CAST(1 + z % 6 AS VARCHAR) END AS product_photos_qty,
       CASE WHEN k % 163 = 0 THEN 'abc' WHEN k % 167 = 0 THEN '-1'
            ELSE CAST(z * 50 + CASE WHEN c = 2 THEN 1 ELSE 0 END AS VARCHAR) END AS product_weight_g,
       CASE WHEN k % 173 = 0 THEN '0' ELSE CAST(z + 5 AS VARCHAR) END AS product_length_cm,
       CAST(z + 2 AS VARCHAR) AS product_height_cm, CAST(z + 3 AS VARCHAR) AS product_width_cm
FROM (SELECT p_partkey AS k, rpad(CAST(p_partkey AS VARCHAR), 32, 'c') AS id, p_name AS n, p_size AS z,
             {_copies('p_partkey % 11 = 0', 'p_partkey % 13 = 0')} AS c FROM part)"""

TABLES["raw_category_translation"] = """
SELECT CASE WHEN p_name = 'old anvil' THEN NULL ELSE replace(p_name, ' ', '_') END AS product_category_name,
       CASE WHEN starts_with(p_name, 'hot') THEN replace(p_name, ' ', '_')
            ELSE ' ' || upper(p_name) END AS product_category_name_english
FROM (SELECT DISTINCT p_name FROM part) WHERE p_name NOT IN ('small ring', 'red widget')"""

TABLES["raw_order_reviews"] = f"""
SELECT CASE WHEN k % 197 = 0 THEN '  ' ELSE ' ' || rpad(CAST(k AS VARCHAR), 32, 'e') END AS review_id,
       CASE WHEN k % 331 = 0 THEN rpad(CAST(k AS VARCHAR), 32, 'f')
            ELSE rpad(CAST((k // 2) * 3 AS VARCHAR), 32, 'a') END AS order_id,
       CASE WHEN k % 211 = 0 THEN 'x' WHEN k % 227 = 0 THEN '0'
            ELSE CAST(CAST(1 + floor(value / 25) AS BIGINT) AS VARCHAR) END AS review_score,
       CASE WHEN k % 5 = 0 THEN NULL WHEN k % 7 = 0 THEN '   ' ELSE ' ' || event_type END
            AS review_comment_title,
       text AS review_comment_message,
       CASE WHEN k % 223 = 0 THEN 'soon' ELSE strftime(ts, '{CLOCK}') END AS review_creation_date,
       strftime(ts + to_days(c) + to_hours(k % 50 - 3), '{CLOCK}') AS review_answer_timestamp
FROM (SELECT event_id AS k, ts, event_type, value, text, {_copies('event_id % 17 = 0')} AS c
      FROM events LEFT JOIN documents ON event_id = doc_id)"""

# ---------------------------------------------------------------------- silver
for _name, _ids in (("customer", ("customer_id", "customer_unique_id")), ("seller", ("seller_id",))):
    TABLES[f"shaped_{_name}s"] = f"""
SELECT {', '.join(_ids)}, {_int(f'{_name}_zip_code_prefix')} AS {_name}_zip_code_prefix,
       lower(trim({_name}_city)) AS {_name}_city, upper(trim({_name}_state)) AS {_name}_state
FROM raw_{_name}s"""
    _present = " AND ".join(
        f"{c} IS NOT NULL" for c in (*_ids, f"{_name}_city", f"{_name}_state")
    )
    TABLES[f"clean_{_name}s"] = f"""
SELECT * FROM shaped_{_name}s
WHERE {_present} AND {_name}_zip_code_prefix BETWEEN 1000 AND 99999"""

TABLES["clean_orders"] = """
SELECT order_id, customer_id, lower(trim(order_status)) AS order_status,
       TRY_CAST(order_purchase_timestamp AS TIMESTAMP) AS order_purchase_timestamp,
       TRY_CAST(order_approved_at AS TIMESTAMP) AS order_approved_at,
       TRY_CAST(order_delivered_carrier_date AS TIMESTAMP) AS order_delivered_carrier_date,
       TRY_CAST(order_delivered_customer_date AS TIMESTAMP) AS order_delivered_customer_date,
       TRY_CAST(order_estimated_delivery_date AS TIMESTAMP) AS order_estimated_delivery_date
FROM raw_orders"""

TABLES["clean_order_items"] = """
SELECT trim(order_id) AS order_id, CAST(order_item_id AS INTEGER) AS order_item_id,
       trim(product_id) AS product_id, trim(seller_id) AS seller_id,
       TRY_CAST(shipping_limit_date AS TIMESTAMP) AS shipping_limit_date, price, freight_value
FROM raw_order_items"""

TABLES["shaped_payments"] = f"""
SELECT id AS order_id, seq AS payment_sequential, t AS payment_type,
       CASE WHEN t = 'credit_card' AND inst = 0 THEN 1 ELSE inst END AS payment_installments,
       v AS payment_value, source_row
FROM (SELECT lower(trim(order_id)) AS id, {_int('payment_sequential')} AS seq,
             lower(trim(payment_type)) AS t, {_int('payment_installments')} AS inst,
             TRY_CAST(payment_value AS DOUBLE) AS v, source_row FROM raw_order_payments)"""

_PAYMENT_COLUMNS = "order_id, payment_sequential, payment_type, payment_installments, payment_value"


def _clean_payments(types: str) -> str:
    return f"""
SELECT {_PAYMENT_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id, payment_sequential ORDER BY source_row) AS rn
  FROM shaped_payments
  WHERE order_id IS NOT NULL AND payment_installments >= 0 AND payment_sequential >= 1
    AND payment_value >= 0 AND length(order_id) = 32 AND payment_type IN ({types}))
WHERE rn = 1"""


TABLES["clean_payments"] = _clean_payments(TYPES)
TABLES["clean_payments_no_undefined"] = _clean_payments(TYPES.replace("'not_defined',", ""))

_MEASURES = {
    "product_name_length": "product_name_lenght",
    "product_description_length": "product_description_lenght",
    "product_photos_qty": "product_photos_qty",
    "product_weight_g": "product_weight_g",
    "product_length_cm": "product_length_cm",
    "product_height_cm": "product_height_cm",
    "product_width_cm": "product_width_cm",
}
_KEY = "nullif(trim(product_category_name), '')"
TABLES["clean_products"] = f"""
SELECT DISTINCT nullif(trim(product_id), '') AS product_id,
       regexp_replace(lower({_KEY}), '[_\\-]+', ' ', 'g') AS product_category_name,
       {', '.join(f'{_int(old)} AS {new}' for new, old in _MEASURES.items())}
FROM raw_products"""

_PRODUCT_RULES = {
    "product_id.missing": ("product_id", "product_id IS NULL"),
    "product_id.not_hex": ("product_id", "NOT regexp_full_match(product_id, '[0-9a-f]{32}')"),
    "product_category_name.untidy": (
        "product_category_name",
        "product_category_name IS NOT NULL AND product_category_name IS DISTINCT FROM "
        f"regexp_replace(lower({_KEY}), '[_\\-]+', ' ', 'g')",
    ),
    "product_weight_g.negative": ("product_weight_g", "product_weight_g < 0"),
    **{
        f"{c}.not_positive": (c, f"{c} <= 0")
        for c in ("product_name_length", "product_description_length", "product_length_cm",
                  "product_height_cm", "product_width_cm")
    },
    "product_photos_qty.below_one": ("product_photos_qty", "product_photos_qty < 1"),
}
TABLES["accepted_products"] = f"""
SELECT * EXCLUDE (n) FROM (
  SELECT *, count(*) OVER (PARTITION BY product_id) AS n FROM clean_products)
WHERE n = 1 AND {' AND '.join(f'NOT coalesce({bad}, false)' for _, bad in _PRODUCT_RULES.values())}"""

TABLES["shaped_reviews"] = f"""
SELECT nullif(trim(review_id), '') AS review_id, nullif(trim(order_id), '') AS order_id,
       {_int('review_score')} AS review_score,
       regexp_replace(nullif(trim(review_comment_title), ''), '[\\r\\n]+', ' ', 'g') AS review_comment_title,
       regexp_replace(nullif(trim(review_comment_message), ''), '[\\r\\n]+', ' ', 'g')
         AS review_comment_message,
       TRY_CAST(review_creation_date AS TIMESTAMP) AS review_creation_date,
       TRY_CAST(review_answer_timestamp AS TIMESTAMP) AS review_answer_timestamp
FROM raw_order_reviews"""

TABLES["accepted_reviews"] = """
SELECT * FROM shaped_reviews
WHERE review_id IS NOT NULL AND order_id IS NOT NULL AND review_score BETWEEN 1 AND 5
  AND review_answer_timestamp >= review_creation_date"""

_FILLED = """review_id, order_id, review_score,
       coalesce(review_comment_title, 'No title') AS review_comment_title,
       coalesce(review_comment_message, 'No comment') AS review_comment_message,
       review_creation_date, review_answer_timestamp,
       review_comment_title IS NOT NULL AS has_comment_title,
       review_comment_message IS NOT NULL AS has_comment_message"""
TABLES["clean_reviews"] = f"""
SELECT {_FILLED} FROM (
  SELECT *, row_number() OVER (PARTITION BY review_id, order_id ORDER BY
    review_answer_timestamp DESC, review_creation_date DESC, review_score,
    review_comment_title NULLS FIRST, review_comment_message NULLS FIRST) AS rn
  FROM accepted_reviews) WHERE rn = 1"""
TABLES["latest_review_per_order"] = f"""
SELECT {_FILLED} FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY
    review_answer_timestamp DESC, review_creation_date DESC, review_id, review_score,
    review_comment_title NULLS FIRST, review_comment_message NULLS FIRST) AS rn
  FROM accepted_reviews) WHERE rn = 1"""

TABLES["clean_category_translation"] = f"""
SELECT product_category_name, product_category_name_english FROM (
  SELECT *, row_number() OVER (PARTITION BY product_category_name
      ORDER BY origin, product_category_name_english NULLS LAST) AS rn
  FROM (
    SELECT regexp_replace(lower(trim(product_category_name)), '[_\\-]+', ' ', 'g') AS product_category_name,
           {_title('product_category_name_english')} AS product_category_name_english, 0 AS origin
    FROM raw_category_translation WHERE product_category_name IS NOT NULL
    UNION ALL SELECT 'pc gamer', 'PC Gamer', 1
    UNION ALL SELECT 'portateis cozinha e preparadores de alimentos',
                     'Food Processors And Portable Kitchen Appliances', 1))
WHERE rn = 1"""

TABLES["clean_category_names"] = f"""
SELECT product_category_name, product_category_name_english FROM (
  SELECT key AS product_category_name, {_title_letters("coalesce(english, '')")}
           AS product_category_name_english,
         row_number() OVER (PARTITION BY key ORDER BY english NULLS FIRST) AS rn
  FROM (SELECT coalesce(regexp_replace(lower({_KEY}), '[_\\-]+', ' ', 'g'), 'unknown') AS key,
               product_category_name_english AS english FROM raw_category_translation))
WHERE rn = 1"""

TABLES["payment_totals"] = """
SELECT order_id, count(*) AS payment_record_count,
       CAST(sum(CAST(payment_value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS order_payment_total
FROM clean_payments GROUP BY order_id"""

# ------------------------------------------------------------------------ gold
TABLES["clean_customers_gold"] = """
SELECT c.customer_id, customer_unique_id, customer_zip_code_prefix,
       lower(trim(customer_city)) AS customer_city, upper(trim(customer_state)) AS customer_state,
       first AS customer_first_purchase_date
FROM clean_customers c JOIN (
  SELECT customer_id, min(order_purchase_timestamp) AS first FROM clean_orders GROUP BY 1) o
  ON c.customer_id = o.customer_id
WHERE first IS NOT NULL AND first <= now()::TIMESTAMP"""

TABLES["category_english"] = f"""
SELECT p.product_id, p.product_category_name,
       {_display('t.product_category_name_english')} AS product_category_name_english
FROM accepted_products p LEFT JOIN clean_category_translation t USING (product_category_name)"""

# The middle of two doubles, rounded half up as it is written out.
TABLES["baseline_price"] = """
SELECT product_id, CAST(round(CAST(CAST(
         prices[(len(prices) + 1) // 2] * CAST(0.5 AS DOUBLE)
         + prices[(len(prices) + 2) // 2] * CAST(0.5 AS DOUBLE)
         AS VARCHAR) AS DECIMAL(30,12)), 2) AS DOUBLE) AS baseline_price_med
FROM (SELECT product_id, list(price ORDER BY price) AS prices
      FROM clean_order_items i JOIN clean_orders o ON i.order_id = o.order_id
      WHERE order_status NOT IN ('canceled', 'unavailable')
        AND CAST(order_purchase_timestamp AS DATE)
            NOT BETWEEN DATE '1998-11-27' AND DATE '1998-11-29'
      GROUP BY product_id)"""
TABLES["baseline_price_by_ranges"] = "SELECT * FROM baseline_price"

TABLES["baseline_price_repeated_values"] = TABLES["baseline_price"].replace(
    "list(price ORDER BY price)", "list(whole ORDER BY whole)"
).replace("FROM clean_order_items i", "FROM (SELECT *, CAST(round(CAST(CAST(price AS VARCHAR) AS DECIMAL(30,12)) / 100) AS DOUBLE) * 100 AS whole FROM clean_order_items) i")

TABLES["dim_customer"] = """
SELECT CAST(row_number() OVER (ORDER BY p.customer_unique_id) AS INTEGER) AS customer_key,
       p.customer_unique_id, f.first_order_date, p.customer_state AS state, p.customer_city AS city
FROM (SELECT *, row_number() OVER (PARTITION BY customer_unique_id ORDER BY customer_id) AS rn
      FROM clean_customers) p
LEFT JOIN (SELECT customer_unique_id, min(CAST(order_purchase_timestamp AS DATE)) AS first_order_date
           FROM clean_orders JOIN clean_customers USING (customer_id) GROUP BY 1) f
  ON p.customer_unique_id = f.customer_unique_id
WHERE p.rn = 1"""
TABLES["dim_customer_by_ranges"] = "SELECT * FROM dim_customer"

TABLES["dim_date"] = """
SELECT date_key, date, year, month, dow,
       CASE WHEN date = bf THEN 'Black Friday' ELSE 'Other Day' END AS is_black_friday,
       CASE WHEN abs(date_diff('day', bf, date)) <= 7 THEN 'Within 7 days of Black Friday'
            ELSE 'More than 7 days away' END AS event_window,
       CASE WHEN dow IN (1, 7) THEN 'Weekend' ELSE 'Weekday' END AS is_weekend,
       CASE p WHEN 1 THEN 'Pre 28 days' WHEN 2 THEN 'Black Friday 3 days'
              WHEN 3 THEN 'Post 28 days' ELSE 'Other days' END AS event_period,
       p AS event_period_sort,
       CASE WHEN p = 2 THEN 'Black Friday' WHEN p IN (1, 3) THEN 'Baseline' ELSE 'Other days' END
         AS period_group,
       CASE WHEN p = 2 THEN 1 WHEN p IN (1, 3) THEN 2 ELSE 3 END AS period_group_sort
FROM (
  SELECT date, CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key,
         CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
         CAST(dayofweek(date) + 1 AS INTEGER) AS dow,
         (SELECT max(f) FROM (SELECT CAST(make_date(year(date), 11, 22 + n) + 1 AS DATE) AS f, n
                              FROM range(7) t(n)) WHERE dayofweek(f) = 5) AS bf,
         CASE WHEN date BETWEEN DATE '1998-10-30' AND DATE '1998-11-26' THEN 1
              WHEN date BETWEEN DATE '1998-11-27' AND DATE '1998-11-29' THEN 2
              WHEN date BETWEEN DATE '1998-11-30' AND DATE '1998-12-27' THEN 3 ELSE 4 END AS p
  FROM (SELECT CAST(unnest(generate_series(date_trunc('year', lo), make_date(year(hi), 12, 31),
                                           INTERVAL 1 DAY)) AS DATE) AS date
        FROM (SELECT min(order_purchase_timestamp) AS lo, max(order_purchase_timestamp) AS hi
              FROM clean_orders)))"""
TABLES["dim_date_period_report"] = """
SELECT period_group_sort, period_group, event_period_sort, event_period, count(*) AS count
FROM dim_date GROUP BY ALL"""

TABLES["dim_product"] = """
SELECT CAST(row_number() OVER (ORDER BY p.product_id) AS INTEGER) AS product_key, p.product_id,
       p.product_category_name AS category_pt, c.product_category_name_english AS category_en,
       p.product_weight_g AS weight_g, p.product_length_cm AS length_cm,
       p.product_height_cm AS height_cm, p.product_width_cm AS width_cm, b.baseline_price_med
FROM accepted_products p JOIN category_english c USING (product_id)
LEFT JOIN baseline_price b USING (product_id)"""

TABLES["dim_seller"] = """
SELECT CAST(row_number() OVER (ORDER BY seller_id) AS INTEGER) AS seller_key, seller_id,
       seller_state, seller_city FROM clean_sellers"""

TABLES["clean_fact_orders"] = """
SELECT DISTINCT * FROM clean_orders
WHERE order_id IS NOT NULL AND customer_id IS NOT NULL
  AND order_purchase_timestamp <= now()::TIMESTAMP"""

TABLES["fact_order"] = """
SELECT o.order_id, d.date_key, c.customer_key, coalesce(i.order_value, 0.0) AS order_value,
       coalesce(i.item_count, 0) AS item_count,
       CASE WHEN order_delivered_customer_date IS NOT NULL AND order_estimated_delivery_date IS NOT NULL
            THEN CAST(greatest(date_diff('day', CAST(order_estimated_delivery_date AS DATE),
                 CAST(order_delivered_customer_date AS DATE)), 0) AS INTEGER) END AS delivery_delay_days,
       coalesce(p.payment_value_total, 0.0) AS payment_value_total,
       coalesce(CAST(order_purchase_timestamp AS DATE) = c.first_order_date, false) AS is_new_at_order
FROM clean_fact_orders o
LEFT JOIN (SELECT order_id, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS order_value,
                  count(*) AS item_count FROM clean_order_items GROUP BY 1) i ON o.order_id = i.order_id
LEFT JOIN (SELECT order_id, CAST(order_payment_total AS DOUBLE) AS payment_value_total FROM payment_totals) p
  ON o.order_id = p.order_id
LEFT JOIN (SELECT customer_id, customer_key, first_order_date
           FROM clean_customers JOIN dim_customer USING (customer_unique_id)) c
  ON o.customer_id = c.customer_id
LEFT JOIN dim_date d ON d.date = CAST(order_purchase_timestamp AS DATE)"""

TABLES["clean_fact_order_item"] = """
SELECT DISTINCT * FROM clean_order_items
WHERE order_id IS NOT NULL AND product_id IS NOT NULL AND seller_id IS NOT NULL
  AND order_item_id > 0 AND shipping_limit_date IS NOT NULL AND price > 0 AND freight_value >= 0"""

TABLES["resolved_items"] = """
SELECT i.*, o.date_key, o.customer_key, p.product_key, s.seller_key, p.baseline_price_med
FROM clean_fact_order_item i LEFT JOIN fact_order o USING (order_id)
LEFT JOIN dim_product p USING (product_id) LEFT JOIN dim_seller s USING (seller_id)"""

_NO_KEY = "(date_key IS NULL OR customer_key IS NULL OR product_key IS NULL OR seller_key IS NULL)"
TABLES["all_fact_order_item"] = """
SELECT order_item_id, order_id, date_key, customer_key, product_key, seller_key, price, freight_value,
       CASE WHEN baseline_price_med > 0
            THEN (baseline_price_med - price) / baseline_price_med * 100.0 END AS price_vs_baseline_pct
FROM resolved_items"""
TABLES["fact_order_item"] = f"SELECT * FROM all_fact_order_item WHERE NOT {_NO_KEY}"
TABLES["orphan_items"] = f"""
SELECT order_id, order_item_id, product_id, seller_id, date_key, customer_key, product_key, seller_key
FROM resolved_items WHERE {_NO_KEY}"""

TABLES["clean_fact_review"] = f"""
SELECT DISTINCT * FROM (
  SELECT trim(review_id) AS review_id, trim(order_id) AS order_id, {_int('review_score')} AS review_score,
         trim(nullif(review_comment_title, '')) AS review_comment_title,
         trim(nullif(review_comment_message, '')) AS review_comment_message,
         TRY_CAST(review_creation_date AS TIMESTAMP) AS review_creation_date,
         TRY_CAST(review_answer_timestamp AS TIMESTAMP) AS review_answer_timestamp
  FROM raw_order_reviews)
WHERE review_id IS NOT NULL AND order_id IS NOT NULL AND review_score BETWEEN 1 AND 5
  AND review_answer_timestamp >= review_creation_date"""

TABLES["all_fact_review"] = """
SELECT r.review_id, r.order_id, o.date_key AS order_date_key, r.review_score
FROM (SELECT DISTINCT review_id, order_id, review_score FROM clean_reviews) r
LEFT JOIN fact_order o ON r.order_id = o.order_id"""
TABLES["fact_review"] = "SELECT * FROM all_fact_review WHERE order_date_key IS NOT NULL"
TABLES["orphan_reviews"] = """
SELECT review_id, order_id, review_score FROM all_fact_review WHERE order_date_key IS NULL"""


# ----------------------------------------------------------------- rule counts
# A row rule is (column to blame, bad-row condition); a table rule two scalar queries,
# the number of bad rows and an example.
RowRules = dict[str, tuple[str, str]]
TableRules = dict[str, tuple[str, str]]
_AMOUNTS = {
    "price", "freight_value", "payment_value", "baseline_price_med", "order_value",
    "payment_value_total", "price_vs_baseline_pct",
}


def _shown(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    if column not in _AMOUNTS:
        return text
    return (
        f"CASE WHEN isnan({column}) THEN 'NaN' WHEN isinf({column}) THEN "
        f"CASE WHEN {column} > 0 THEN 'Infinity' ELSE '-Infinity' END ELSE {text} END"
    )


def _counts(table: str, rows: RowRules, extra: TableRules, warnings: tuple[str, ...] = ()) -> str:
    parts = [("row_count", "info", f"SELECT count(*) AS n, CAST(NULL AS VARCHAR) AS e FROM {table}")]
    for name, (column, bad) in rows.items():
        query = f"SELECT count(*) AS n, min({_shown(column)}) AS e FROM {table} WHERE {bad}"
        parts.append((name, "warning" if name in warnings else "error", query))
    for name, (count, example) in extra.items():
        parts.append((name, "error", f"SELECT ({count}) AS n, ({example}) AS e"))
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, '{severity}' AS severity, CAST(n AS BIGINT) AS bad_rows, "
        f"e AS example FROM ({query})"
        for name, severity, query in parts
    )


_NO_EXAMPLE = "CAST(NULL AS VARCHAR)"


def _repeated(table: str, *keys: str, measure: str = "count(*)", where: str = "true") -> tuple[str, str]:
    listed = ", ".join(keys)
    groups = (
        f"(SELECT {listed}, count(*) AS n FROM {table} WHERE {where} GROUP BY {listed} "
        "HAVING count(*) > 1)"
    )
    return (
        f"SELECT coalesce({measure}, 0) FROM {groups}",
        f"SELECT min(concat_ws(', ', {listed})) FROM {groups}",
    )


def _orphans(rows: str, keys: tuple[str, ...], parent: str, parent_keys: tuple[str, ...]) -> tuple[str, str]:
    same = " AND ".join(f"p.{b} = c.{a}" for a, b in zip(keys, parent_keys))
    lost = f"(SELECT * FROM {rows} c WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE {same}))"
    return (
        f"SELECT count(*) FROM {lost}",
        f"SELECT min(concat_ws(', ', {', '.join(keys)})) FROM {lost}",
    )


def _missing(*columns: str) -> RowRules:
    return {f"{c}.missing": (c, f"{c} IS NULL") for c in columns}


def _empty(table: str) -> tuple[str, str]:
    return f"SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {table}", _NO_EXAMPLE


def _party(name: str, *ids: str):
    state, zip_code = f"{name}_state", f"{name}_zip_code_prefix"
    rows = {
        **_missing(*ids, f"{name}_city", state),
        f"{state}.unknown": (state, f"{state} NOT IN ({STATE_LIST})"),
        f"{zip_code}.out_of_range": (zip_code, f"{zip_code} NOT BETWEEN 1000 AND 99999"),
    }
    return f"shaped_{name}s", rows, lambda t: {f"{name}_id.repeated": _repeated(t, f"{name}_id")}


_ORDER_RULES: RowRules = {
    **_missing("order_id", "customer_id", "order_status", "order_purchase_timestamp"),
    "order_status.unknown": ("order_status", f"order_status NOT IN ({STATUSES})"),
    **{
        f"{c}.before_purchase": (c, f"{c} < order_purchase_timestamp")
        for c in ("order_approved_at", "order_delivered_carrier_date")
    },
}
_ITEM_RULES: RowRules = {
    **_missing("order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date"),
    "order_item_id.not_positive": ("order_item_id", "order_item_id <= 0"),
    "price.not_positive": ("price", "price IS NULL OR price <= 0"),
    "freight_value.negative": ("freight_value", "freight_value IS NULL OR freight_value < 0"),
}
_PAYMENT_RULES: RowRules = {
    **_missing(*_PAYMENT_COLUMNS.split(", ")),
    "order_id.wrong_length": ("order_id", "length(order_id) <> 32"),
    "payment_sequential.below_one": ("payment_sequential", "payment_sequential < 1"),
    "payment_value.negative": ("payment_value", "payment_value < 0"),
    "payment_installments.negative": ("payment_installments", "payment_installments < 0"),
    "payment_installments.none_on_card":
        ("payment_installments", "payment_type = 'credit_card' AND payment_installments = 0"),
    "payment_type.unknown": ("payment_type", f"payment_type NOT IN ({TYPES})"),
    "payment_value.zero": ("payment_value", "payment_value = 0"),
    "payment_installments.zero":
        ("payment_installments", "payment_type <> 'credit_card' AND payment_installments = 0"),
}
_WARNINGS = ("payment_value.zero", "payment_installments.zero")
TABLES["filled_reviews"] = f"SELECT {_FILLED} FROM shaped_reviews"


def _breaks(column: str) -> str:
    return f"contains({column}, chr(10)) OR contains({column}, chr(13))"


_REVIEW_RULES: RowRules = {
    "no_nulls_in_key_columns": (
        "review_id",
        "review_id IS NULL OR order_id IS NULL OR review_score IS NULL "
        "OR review_creation_date IS NULL OR review_answer_timestamp IS NULL",
    ),
    "comments_filled": (
        "review_id",
        "coalesce(review_comment_title, '') = '' OR coalesce(review_comment_message, '') = ''",
    ),
    "score_between_1_and_5": ("review_score", "review_score NOT BETWEEN 1 AND 5"),
    "answer_after_creation":
        ("review_answer_timestamp", "review_answer_timestamp < review_creation_date"),
    "no_line_breaks_in_comments": (
        "review_id", f"{_breaks('review_comment_title')} OR {_breaks('review_comment_message')}"
    ),
}
_DATE_COLUMNS = (
    "date_key", "date", "year", "month", "dow", "is_black_friday", "event_window", "is_weekend",
    "event_period", "event_period_sort", "period_group", "period_group_sort",
)
# What each attribute of a day has to be, from the day alone.
_DAY = "TRY_CAST(CASE WHEN regexp_full_match(CAST(date AS VARCHAR), '\\d{4}-\\d{2}-\\d{2}') THEN CAST(date AS VARCHAR) END AS DATE)"
_FRIDAY = (
    f"(make_date(year({_DAY}), 11, 1) + CAST((11 - dayofweek(make_date(year({_DAY}), 11, 1))) % 7 + 22 AS INTEGER))"
)
_PERIOD = (
    f"(CASE WHEN {_DAY} BETWEEN DATE '1998-10-30' AND DATE '1998-11-26' THEN 1 "
    f"WHEN {_DAY} BETWEEN DATE '1998-11-27' AND DATE '1998-11-29' THEN 2 "
    f"WHEN {_DAY} BETWEEN DATE '1998-11-30' AND DATE '1998-12-27' THEN 3 ELSE 4 END)"
)
_EXPECTED = {
    "date_key": f"year({_DAY}) * 10000 + month({_DAY}) * 100 + day({_DAY})",
    "year": f"year({_DAY})",
    "month": f"month({_DAY})",
    "dow": f"dayofweek({_DAY}) + 1",
    "is_black_friday": f"CASE WHEN {_DAY} = {_FRIDAY} THEN 'Black Friday' ELSE 'Other Day' END",
    "event_window": f"CASE WHEN abs(date_diff('day', CAST({_FRIDAY} AS DATE), {_DAY})) <= 7 "
    "THEN 'Within 7 days of Black Friday' ELSE 'More than 7 days away' END",
    "is_weekend": f"CASE WHEN dayofweek({_DAY}) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END",
    "event_period": f"['Pre 28 days', 'Black Friday 3 days', 'Post 28 days', 'Other days'][{_PERIOD}]",
    "event_period_sort": _PERIOD,
    "period_group": f"['Baseline', 'Black Friday', 'Baseline', 'Other days'][{_PERIOD}]",
    "period_group_sort": f"[2, 1, 2, 3][{_PERIOD}]",
}
_DATE_RULES: RowRules = {
    **_missing(*_DATE_COLUMNS),
    "date.wrong_format":
        ("date", "NOT regexp_full_match(CAST(date AS VARCHAR), '\\d{4}-\\d{2}-\\d{2}')"),
    "date.unreadable": ("date", f"{_DAY} IS NULL"),
    **{f"{c}.differs": (c, f"{_DAY} IS NOT NULL AND {c} <> {e}") for c, e in _EXPECTED.items()},
}
_PRODUCT_DIM_RULES: RowRules = {
    **_missing("product_key", "product_id"),
    "baseline_price_med.not_positive": (
        "baseline_price_med",
        "baseline_price_med <= 0 OR isnan(baseline_price_med) OR isinf(baseline_price_med)",
    ),
    "category_en.untidy": (
        "category_en", f"category_en IS NOT NULL AND category_en IS DISTINCT FROM {_display('category_en')}"
    ),
    "category_pt.untranslated": (
        "category_pt",
        "category_en IS NULL AND product_id IN (SELECT product_id FROM clean_products WHERE "
        "product_category_name NOT IN ('pc gamer', 'portateis cozinha e preparadores de alimentos'))",
    ),
}


def _not_finite(c: str) -> str:
    return f"isnan({c}) OR isinf({c})"


_FACT_ITEM_RULES: RowRules = {
    **_missing("order_item_id", "order_id", "date_key", "customer_key", "product_key", "seller_key",
               "price", "freight_value"),
    "order_item_id.not_positive": ("order_item_id", "order_item_id <= 0"),
    "price.invalid": ("price", f"price <= 0 OR {_not_finite('price')}"),
    "freight_value.invalid": ("freight_value", f"freight_value < 0 OR {_not_finite('freight_value')}"),
    "price_vs_baseline_pct.invalid":
        ("price_vs_baseline_pct", _not_finite("price_vs_baseline_pct")),
}
_PERIODS = (("Pre 28 days", 28), ("Black Friday 3 days", 3), ("Post 28 days", 28))


def _calendar_rules(t: str) -> TableRules:
    return {
        **{f"{c}.repeated": _repeated(t, c) for c in ("date_key", "date")},
        "calendar.gap": (
            f"SELECT abs(date_diff('day', min({_DAY}), max({_DAY})) + 1 - count(*)) FROM {t}", _NO_EXAMPLE
        ),
        **{
            f"{label}.wrong_length":
                (f"SELECT abs(count(*) FILTER (WHERE event_period = '{label}') - {n}) FROM {t}", _NO_EXAMPLE)
            for label, n in _PERIODS
        },
    }


# Rule set -> (table, row rules, function of the table that gives the table rules).
RULED = {
    "customers": _party("customer", "customer_id", "customer_unique_id"),
    "sellers": _party("seller", "seller_id"),
    "orders": ("clean_orders", _ORDER_RULES, lambda t: {"order_id.repeated": _repeated(t, "order_id")}),
    "order_items": (
        "clean_order_items", _ITEM_RULES,
        lambda t: {"order_line.repeated": _repeated(t, "order_id", "order_item_id")},
    ),
    "payments": (
        "shaped_payments", _PAYMENT_RULES,
        lambda t: {"payment.repeated": _repeated(t, "order_id", "payment_sequential", measure="sum(n)")},
    ),
    "products": (
        "clean_products", _PRODUCT_RULES,
        lambda t: {"product_id.repeated": _repeated(
            t, "product_id", measure="sum(n - 1)", where="product_id IS NOT NULL")},
    ),
    "reviews": (
        "filled_reviews", _REVIEW_RULES,
        lambda t: {
            "review_order_key_unique": _repeated(t, "review_id", "order_id"),
            "one_review_per_order": _repeated(t, "order_id"),
            "order_ids_exist_in_orders": _orphans(
                f"(SELECT DISTINCT order_id FROM {t})", ("order_id",), "clean_orders", ("order_id",)),
        },
    ),
    "category": (
        "clean_category_translation", _missing("product_category_name"),
        lambda t: {"table.empty": _empty(t)},
    ),
    "category_names": (
        "raw_category_translation", _missing("product_category_name"),
        lambda t: {"product_category_name.repeated": _repeated(
            t, "product_category_name", measure="sum(n - 1)")},
    ),
    "dim_customer": (
        "dim_customer",
        {
            **_missing("customer_key", "customer_unique_id", "first_order_date", "state", "city"),
            "state.unknown": ("state", f"state NOT IN ({STATE_LIST})"),
            "city.untidy": ("city", "city <> lower(trim(city))"),
            "first_order_date.unreadable":
                ("first_order_date", "TRY_CAST(first_order_date AS TIMESTAMP) IS NULL"),
            "first_order_date.future":
                ("first_order_date", "TRY_CAST(first_order_date AS TIMESTAMP) > now()::TIMESTAMP"),
        },
        lambda t: {f"{c}.repeated": _repeated(t, c) for c in ("customer_key", "customer_unique_id")},
    ),
    "dim_date": ("dim_date", _DATE_RULES, _calendar_rules),
    "dim_product": (
        "dim_product", _PRODUCT_DIM_RULES,
        lambda t: {
            "table.empty": _empty(t),
            "product_id.repeated": _repeated(
                t, "product_id", measure="sum(n - 1)", where="product_id IS NOT NULL"),
            "table.wrong_size": (
                f"SELECT abs((SELECT count(*) FROM {t}) - (SELECT count(*) FROM "
                "(SELECT DISTINCT product_id FROM clean_products)))", _NO_EXAMPLE),
        },
    ),
    "dim_seller": (
        "dim_seller",
        {
            **_missing("seller_key", "seller_id", "seller_state", "seller_city"),
            "seller_state.unknown": ("seller_state", f"seller_state NOT IN ({STATE_LIST})"),
            "seller_city.untidy": ("seller_city", "seller_city <> lower(trim(seller_city))"),
        },
        lambda t: {f"{c}.repeated": _repeated(t, c) for c in ("seller_key", "seller_id")},
    ),
    "fact_order": (
        "fact_order",
        {
            **_missing("order_id", "date_key", "customer_key", "is_new_at_order"),
            **{
                f"{c}.invalid": (c, f"{c} IS NULL OR {c} < 0" + (f" OR {_not_finite(c)}" if c in _AMOUNTS else ""))
                for c in ("order_value", "item_count", "payment_value_total")
            },
        },
        lambda t: {"order_id.repeated": _repeated(t, "order_id")},
    ),
    "fact_order_item": (
        "all_fact_order_item", _FACT_ITEM_RULES,
        lambda t: {
            "order_line.repeated": _repeated(t, "order_id", "order_item_id"),
            "order_keys.orphan": _orphans(
                t, ("order_id", "date_key", "customer_key"), "fact_order", ("order_id", "date_key", "customer_key")),
        },
    ),
    "fact_review": (
        "all_fact_review",
        {
            **_missing("review_id", "order_id", "order_date_key", "review_score"),
            "review_score.out_of_range": ("review_score", "review_score NOT BETWEEN 1 AND 5"),
        },
        lambda t: {
            "review_id.repeated": _repeated(t, "review_id"),
            "order_keys.orphan": _orphans(t, ("order_id", "order_date_key"), "fact_order", ("order_id", "date_key")),
        },
    ),
}
_COLUMNS = {
    "customers": "customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state",
    "sellers": "seller_id, seller_zip_code_prefix, seller_city, seller_state",
    "orders": "order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at, order_delivered_carrier_date",
    "order_items": "order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value",
    "payments": _PAYMENT_COLUMNS,
    "products": ", ".join(("product_id", "product_category_name", *_MEASURES)),
    "reviews": "review_id, order_id, review_score, review_comment_title, review_comment_message, "
    "review_creation_date, review_answer_timestamp",
    "category": "product_category_name", "category_names": "product_category_name",
    "dim_customer": "customer_key, customer_unique_id, CAST(first_order_date AS VARCHAR) AS first_order_date, state, city",
    "dim_date": ", ".join(_DATE_COLUMNS).replace(" date,", " CAST(date AS VARCHAR) AS date,"),
    "dim_product": "product_key, product_id, category_pt, category_en, baseline_price_med",
    "dim_seller": "seller_key, seller_id, seller_state, seller_city",
    "fact_order": "order_id, date_key, customer_key, order_value, item_count, payment_value_total, is_new_at_order",
    "fact_order_item": "order_item_id, order_id, date_key, customer_key, product_key, seller_key, price, "
    "freight_value, price_vs_baseline_pct",
    "fact_review": "review_id, order_id, order_date_key, review_score",
}


def _spoiled(name: str, table: str) -> str:
    """The table with the faults that the query puts in."""
    spoil, columns = SPOILS[name], _COLUMNS[name]
    names = [re.split(r"\s+AS\s+|\s+", c.strip())[-1] for c in re.split(r",\s*(?![^(]*\))", columns)]
    keys = ", ".join(f"CAST({k} AS VARCHAR)" for k in spoil.keys)
    return f"""
SELECT * EXCLUDE (spoil_copy) FROM (
  SELECT {', '.join(spoil.columns(names))}, unnest(CASE WHEN {spoil.copies} THEN [0, 1] ELSE [0] END) AS spoil_copy
  FROM (SELECT {columns}, CAST('0x' || substr(md5(concat_ws('|', {keys})), 1, 6) AS BIGINT) AS {NUMBER} FROM {table})
  WHERE NOT ({spoil.drop}))"""


STATEMENTS: dict[str, str] = {}
for _name, (_table, _rows, _more) in RULED.items():
    STATEMENTS[f"rule_counts_{_name}"] = _counts(_table, _rows, _more(_table), _WARNINGS)
    TABLES[f"spoiled_{_name}"] = _spoiled(_name, _table)
    STATEMENTS[f"rule_counts_{_name}_spoiled"] = _counts(
        f"spoiled_{_name}", _rows, _more(f"spoiled_{_name}"), _WARNINGS
    )
for _name, _gone in (("category", "product_category_name = 'none'"), ("dim_product", "product_key < 0")):
    _table, _rows, _more = RULED[_name]
    TABLES[f"spoiled_no_{_name}"] = f"SELECT * FROM {_table} WHERE {_gone}"
    STATEMENTS[f"rule_counts_{_name}_none"] = _counts(
        f"spoiled_no_{_name}", _rows, _more(f"spoiled_no_{_name}"), _WARNINGS
    )
STATEMENTS["rule_counts_payments_untyped"] = (
    "SELECT 'schema' AS rule, 'error' AS severity, CAST(3 AS BIGINT) AS bad_rows, "
    "'payment_sequential is string, expected int' AS example"
)
STATEMENTS["payment_type_offenders"] = (
    f"SELECT payment_type AS invalid_value, count(*) AS bad_rows FROM shaped_payments "
    f"WHERE payment_type NOT IN ({TYPES}) GROUP BY 1"
)
STATEMENTS["clean_payments_odd_headers"] = "SELECT * FROM clean_payments"
STATEMENTS["clean_products_marked_headers"] = "SELECT * FROM clean_products"


# ---------------------------------------------------------------- invalid rows
def _invalid(dataset: str, table: str, rules: dict[str, tuple[str, str]], more: str = "") -> str:
    parts = [
        f"SELECT '{dataset}' AS dataset, '{column}' AS column_name, '{name}' AS rule, "
        f"CAST({column} AS VARCHAR) AS invalid_value FROM {table} WHERE {bad}"
        for name, (column, bad) in rules.items()
    ]
    return " UNION ALL ".join(parts) + more


def _repeated_rows(dataset: str, table: str, rule: str, *keys: str, where: str = "true") -> str:
    listed = ", ".join(keys)
    return (
        f" UNION ALL SELECT '{dataset}', '{keys[0]}', '{rule}', {keys[0]} FROM (SELECT {listed}, "
        f"count(*) OVER (PARTITION BY {listed}) AS n FROM {table} WHERE {where}) WHERE n > 1"
    )


STATEMENTS["invalid_rows_orders"] = _invalid(
    "silver_orders", "clean_orders", _ORDER_RULES,
    _repeated_rows("silver_orders", "clean_orders", "order_id.repeated", "order_id"),
)
STATEMENTS["invalid_rows_order_items"] = _invalid(
    "silver_order_items", "clean_order_items", _ITEM_RULES,
    _repeated_rows("silver_order_items", "clean_order_items", "order_line.repeated", "order_id", "order_item_id"),
)
STATEMENTS["invalid_rows_products"] = _invalid(
    "silver_products", "clean_products", _PRODUCT_RULES,
    _repeated_rows("silver_products", "clean_products", "product_id.repeated", "product_id",
                   where="product_id IS NOT NULL"),
)


def _required(*columns: str) -> dict[str, tuple[str, str]]:
    return {f"{c} is present": (c, f"{c} IS NULL") for c in columns}


def _unless(column: str, ok: str) -> tuple[str, str]:
    return column, f"NOT coalesce({ok}, false)"


for _name, _ids in (("customer", ("customer_id", "customer_unique_id")), ("seller", ("seller_id",))):
    _z = f"{_name}_zip_code_prefix"
    STATEMENTS[f"invalid_rows_{_name}s"] = _invalid(
        f"{_name}s", f"shaped_{_name}s",
        {
            **_required(*_ids, f"{_name}_city", f"{_name}_state"),
            "zip code in range": _unless(_z, f"{_z} BETWEEN 1000 AND 99999"),
        },
    )
STATEMENTS["invalid_rows_order_payments"] = _invalid(
    "order_payments", "shaped_payments",
    {
        **_required(*_PAYMENT_COLUMNS.split(", ")),
        "installments not negative": _unless("payment_installments", "payment_installments >= 0"),
        "sequence starts at one": _unless("payment_sequential", "payment_sequential >= 1"),
        "value not negative": _unless("payment_value", "payment_value >= 0"),
        "order id has full length": _unless("order_id", "length(order_id) = 32"),
        "payment type is known": _unless("payment_type", f"payment_type IN ({TYPES})"),
    },
)
STATEMENTS["invalid_rows_order_reviews"] = _invalid(
    "order_reviews", "shaped_reviews",
    {
        **_required("review_id", "order_id", "review_score", "review_creation_date",
                    "review_answer_timestamp"),
        "score in range": _unless("review_score", "review_score BETWEEN 1 AND 5"),
        "answered after creation": _unless(
            "review_answer_timestamp", "review_answer_timestamp >= review_creation_date"
        ),
    },
)

# --------------------------------------------------- logs, profiles, comparisons
_LOGGED = {
    "customers": ("raw_customers", "clean_customers"),
    "sellers": ("raw_sellers", "clean_sellers"),
    "orders": ("raw_orders", "clean_orders"),
    "order_items": ("raw_order_items", "clean_order_items"),
    "order_payments": ("raw_order_payments", "clean_payments"),
    "products": ("raw_products", "clean_products"),
    "order_reviews": ("raw_order_reviews", "clean_reviews"),
}


def _any(rules: RowRules) -> str:
    return " OR ".join(f"coalesce({bad}, false)" for _, bad in rules.values())


def _broken(table: str, rules: RowRules, *keys: str, where: str = "true") -> str:
    """Rows that break a row rule or share their key."""
    return (
        f"SELECT * EXCLUDE (n) FROM (SELECT *, count(*) OVER (PARTITION BY {', '.join(keys)}) AS n FROM {table}) "
        f"WHERE (n > 1 AND {where}) OR {_any(rules)}"
    )


def _acceptance(*present: str, **more: str) -> RowRules:
    return {**_missing(*present), **{c: (c, f"NOT coalesce({ok}, false)") for c, ok in more.items()}}


_PARTY = {n: _acceptance(*ids, f"{n}_city", f"{n}_state", **{f"{n}_zip_code_prefix": f"{n}_zip_code_prefix BETWEEN 1000 AND 99999"})
          for n, ids in (("customer", ("customer_id", "customer_unique_id")), ("seller", ("seller_id",)))}
# Rows of each table that are rejected.
REJECTED = {
    "customers": f"SELECT * FROM shaped_customers WHERE {_any(_PARTY['customer'])}",
    "sellers": f"SELECT * FROM shaped_sellers WHERE {_any(_PARTY['seller'])}",
    "orders": _broken("clean_orders", _ORDER_RULES, "order_id"),
    "order_items": _broken("clean_order_items", _ITEM_RULES, "order_id", "order_item_id"),
    "order_payments": "SELECT * FROM shaped_payments WHERE NOT coalesce(order_id IS NOT NULL AND payment_installments >= 0 "
    f"AND payment_sequential >= 1 AND payment_value >= 0 AND length(order_id) = 32 AND payment_type IN ({TYPES}), false)",
    "products": _broken("clean_products", _PRODUCT_RULES, "product_id", where="product_id IS NOT NULL"),
    "order_reviews": "SELECT * FROM shaped_reviews WHERE NOT coalesce(review_id IS NOT NULL AND order_id IS NOT NULL "
    "AND review_score BETWEEN 1 AND 5 AND review_answer_timestamp >= review_creation_date, false)",
}


def _dq_row(name: str, raw: str, clean: str) -> str:
    return (
        f"SELECT '{name}' AS dataset, b AS silver_before, a AS silver_after, b - a AS dropped_rows, "
        f"i AS invalid_rows, a > 0 AS dq_pass FROM (SELECT (SELECT count(*) FROM {raw}) AS b, "
        f"(SELECT count(*) FROM {clean}) AS a, (SELECT count(*) FROM ({REJECTED[name]})) AS i)"
    )


STATEMENTS["dq_summary"] = " UNION ALL ".join(
    _dq_row(name, raw, clean) for name, (raw, clean) in _LOGGED.items()
)


def _history(invalid: str) -> str:
    return f"""
WITH latest AS (
  SELECT event_type, user_id % 3 AS stage, user_id * 10 AS row_count,
         row_number() OVER (PARTITION BY event_type, user_id % 3 ORDER BY ts DESC, user_id DESC) AS rn
  FROM events),
counts AS (
  SELECT event_type AS dataset, max(row_count) FILTER (WHERE stage = 0 AND rn = 1) AS silver_before,
         max(row_count) FILTER (WHERE stage = 1 AND rn = 1) AS silver_after
  FROM latest GROUP BY 1),
invalid AS ({invalid})
SELECT c.dataset, silver_before, silver_after, silver_before - silver_after AS dropped_rows,
       invalid_rows, silver_after > 0 AS dq_pass
FROM counts c LEFT JOIN invalid i ON c.dataset = i.dataset"""


STATEMENTS["dq_summary_history"] = _history(
    "SELECT event_type AS dataset, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS invalid_rows "
    "FROM events GROUP BY 1"
)
STATEMENTS["dq_summary_history_latest"] = _history(
    "SELECT event_type AS dataset, CAST(floor(value) AS BIGINT) AS invalid_rows FROM events "
    "QUALIFY row_number() OVER (PARTITION BY event_type "
    "ORDER BY ts DESC, value DESC) = 1"
)
TABLES["reconcile_orders_lines"] = """
SELECT coalesce(l.k, r.k) AS order_key,
       CASE WHEN r.k IS NULL THEN 'missing' WHEN l.k IS NULL THEN 'extra' ELSE 'matched' END AS status
FROM (SELECT DISTINCT o_orderkey AS k FROM orders) l
FULL JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem) r ON l.k = r.k"""
STATEMENTS["reconcile_summary"] = """
SELECT count(*) FILTER (WHERE status <> 'extra') AS left_keys,
       count(*) FILTER (WHERE status <> 'missing') AS right_keys,
       count(*) FILTER (WHERE status = 'missing') AS missing_keys,
       count(*) FILTER (WHERE status = 'extra') AS extra_keys
FROM reconcile_orders_lines"""
STATEMENTS["page_paths"] = """
SELECT page_id, CASE WHEN contains(url, '/en/') THEN split_part(url, '/en/', 2) ELSE url END AS path
FROM pages"""
_PROFILED = {
    "region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11,
    "events": 6, "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3,
    "conversations": 4,
}


def _profile(names) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count, {_PROFILED[n]} AS column_count FROM {n}"
        for n in names
    )


STATEMENTS["table_profile"] = _profile(_PROFILED)
STATEMENTS["export_profile"] = _profile(_PROFILED)
_BY_STATUS = "SELECT '{}' AS sink, o_orderstatus, count(*){} AS count, {} AS column_count FROM orders GROUP BY 2"
STATEMENTS["sinks"] = " UNION ALL ".join(
    _BY_STATUS.format(*x) for x in (("append", " * 2", 2), ("replace", "", 1), ("path", "", 2))
)

# ------------------------------------------------------- a run, from raw to published
TABLES["kept_orders"] = f"SELECT * FROM clean_orders EXCEPT ALL ({REJECTED['orders']})"
TABLES["kept_order_items"] = f"SELECT * FROM clean_order_items EXCEPT ALL ({REJECTED['order_items']})"
for _name in ("customer", "seller"):
    TABLES[f"kept_{_name}s"] = f"SELECT * FROM clean_{_name}s WHERE {_name}_state IN ({STATE_LIST})"
_KEPT = {f"clean_{n}": f"kept_{n}" for n in ("orders", "order_items", "customers", "sellers")}
for _name in ("dim_seller", "baseline_price", "dim_customer", "dim_date", "dim_product", "clean_fact_orders", "fact_order",
              "clean_fact_order_item", "resolved_items", "all_fact_order_item", "all_fact_review"):
    _KEPT[_name] = f"run_{_name}"
    TABLES[f"run_{_name}"] = re.sub(r"\w+", lambda m: _KEPT.get(m[0], m[0]), TABLES[_name])
STATEMENTS["published_fact_order_item"] = f"SELECT * FROM run_all_fact_order_item WHERE NOT {_NO_KEY}"
STATEMENTS["published_fact_review"] = "SELECT * FROM run_all_fact_review WHERE order_date_key IS NOT NULL"
_RUN = {**_LOGGED, "customers": ("raw_customers", "kept_customers"), "sellers": ("raw_sellers", "kept_sellers"), "orders": ("raw_orders", "kept_orders"), "order_items": ("raw_order_items", "kept_order_items"),
        "products": ("raw_products", "accepted_products")}
_CATEGORY = "(SELECT count(*) FROM raw_category_translation) AS b, (SELECT count(*) FROM clean_category_translation) AS a"
_STATE_RULES = {f"{n}s": {f"{n}_state.unknown": (f"{n}_state", f"{n}_state NOT IN ({STATE_LIST})")} for n in ("customer", "seller")}
for _name, _rules in _STATE_RULES.items():
    REJECTED[_name] += f" OR {_any(_rules)}"
STATEMENTS["published_summary"] = " UNION ALL ".join(
    [*(_dq_row(name, *tables) for name, tables in _RUN.items()),
     f"SELECT 'product_category', b, a, b - a, CAST(NULL AS BIGINT), a > 0 FROM (SELECT {_CATEGORY})"]
)
STATEMENTS["published_row_counts"] = " UNION ALL ".join(
    f"SELECT '{name}' AS dataset, '{stage}' AS stage, count(*) AS row_count FROM {table}"
    for name, tables in {**_RUN, "product_category": ("raw_category_translation", "clean_category_translation")}.items()
    for stage, table in zip(("silver_before_clean", "silver_after_clean"), tables)
)
STATEMENTS["published_invalid_counts"] = " UNION ALL ".join(
    f"SELECT '{name}' AS dataset, count(*) AS invalid_rows FROM ({rows})" for name, rows in REJECTED.items()
)
STATEMENTS["published_invalid_rows"] = " UNION ALL ".join(
    f"SELECT '{name}' AS dataset, column_name, rule, invalid_value FROM ({STATEMENTS[f'invalid_rows_{name}']}"
    + (" UNION ALL " + _invalid(name, f"shaped_{name}", _STATE_RULES[name]) if name in _STATE_RULES else "") + ")"
    for name in REJECTED
)
STATEMENTS["payments_from_csv"] = "SELECT * FROM clean_payments"
STATEMENTS["reviews_from_csv"] = "SELECT * FROM clean_reviews"

STATEMENTS["reviews_from_one_csv"] = "SELECT * FROM clean_reviews"

# Payment lines of which some lack their last field and some have one too many.
_FIELDS = [f"coalesce({c}, '')" for c in _PAYMENT_COLUMNS.split(", ")]
TABLES["raw_payment_lines"] = f"""
SELECT CASE WHEN source_row % 29 = 0 THEN concat_ws(',', {", ".join(_FIELDS[:-1])})
            ELSE concat_ws(',', {", ".join(_FIELDS)}, 'surplus') END AS malformed_line
FROM raw_order_payments WHERE source_row % 29 = 0 OR source_row % 31 = 0"""
_PLACED = "source_row % 29 <> 0 AND source_row % 31 <> 0"
TABLES["all_placed_payments"] = f"SELECT * FROM shaped_payments WHERE {_PLACED}"
STATEMENTS["malformed_payments_invalid_rows"] = (
    STATEMENTS["invalid_rows_order_payments"].replace("FROM shaped_payments", "FROM all_placed_payments")
    + " UNION ALL SELECT 'order_payments', 'line', 'line is well formed', malformed_line FROM raw_payment_lines"
)
_REJECTED_PLACED = REJECTED["order_payments"].replace("FROM shaped_payments", "FROM all_placed_payments")
_NAMED = ", ".join(
    f"CASE WHEN {bad} THEN '{name}' END"
    for name, (_, bad) in {
        **_required(*_PAYMENT_COLUMNS.split(", ")),
        "installments not negative": _unless("payment_installments", "payment_installments >= 0"),
        "sequence starts at one": _unless("payment_sequential", "payment_sequential >= 1"),
        "value not negative": _unless("payment_value", "payment_value >= 0"),
        "order id has full length": _unless("order_id", "length(order_id) = 32"),
        "payment type is known": _unless("payment_type", f"payment_type IN ({TYPES})"),
    }.items()
)
STATEMENTS["malformed_payments_quarantine"] = (
    f"SELECT {_PAYMENT_COLUMNS}, list_filter([{_NAMED}], lambda x: x IS NOT NULL) AS rules FROM ({_REJECTED_PLACED}) "
    "UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, ['line is well formed'] FROM raw_payment_lines"
)
STATEMENTS["malformed_payments_tally"] = f"""
SELECT (SELECT count(*) FROM raw_order_payments) AS silver_before,
  (SELECT count(*) FROM ({_clean_payments(TYPES).replace("FROM shaped_payments", "FROM all_placed_payments")})) AS silver_after,
  (SELECT count(*) FROM raw_payment_lines) + (SELECT count(*) FROM ({_REJECTED_PLACED})) AS invalid_rows"""

STATEMENTS["reconcile_orders_unique"] = """
SELECT o_orderkey AS order_key, CASE WHEN o_orderkey % 900 = 0 OR o_orderkey % 1100 = 0 THEN 'missing' ELSE 'matched' END AS status FROM orders
UNION ALL SELECT -o_orderkey, 'extra' FROM orders WHERE o_orderkey % 900 <> 0 AND o_orderkey % 1100 = 0"""

# Dimensions of which the natural keys without a 7 were loaded first and keep their keys.
for _table, _key, _natural in (("dim_seller", "seller_key", "seller_id"), ("dim_customer", "customer_key", "customer_unique_id")):
    STATEMENTS[f"{_table}_reloaded"] = (
        f"SELECT * REPLACE (CAST(row_number() OVER (ORDER BY contains({_natural}, '7'), {_natural}) AS INTEGER) AS {_key}) FROM {_table}"
    )

# Orders after new files for each March: some are cancelled, and the 15th is gone.
_MARCH = "month(order_purchase_timestamp) = 3"
_DAY = "day(order_purchase_timestamp)"
TABLES["raw_later_orders"] = f"""
SELECT * REPLACE (CASE WHEN {_MARCH} AND {_DAY} <= 10 AND order_status = 'SHIPPED' THEN 'canceled'
                       ELSE order_status END AS order_status)
FROM raw_orders WHERE NOT ({_MARCH} AND {_DAY} = 15)"""
STATEMENTS["incremental_orders"] = TABLES["clean_orders"].replace("FROM raw_orders", "FROM raw_later_orders")
STATEMENTS["incremental_orders_days"] = f"""
SELECT DISTINCT CAST(1 AS INTEGER) AS run, 'written' AS action, strftime(order_purchase_timestamp, '%Y-%m-%d') AS load_day
FROM raw_orders
UNION ALL
SELECT DISTINCT CAST(3 AS INTEGER), CASE WHEN {_DAY} = 15 THEN 'removed' ELSE 'written' END,
       strftime(order_purchase_timestamp, '%Y-%m-%d')
FROM raw_orders WHERE {_MARCH} AND ({_DAY} = 15 OR {_DAY} <= 10 AND order_status = 'SHIPPED')"""

# Subqueries that only serve others.
_HELPERS = {
    n for n in TABLES
    if n.startswith(("raw_", "shaped_", "accepted_reviews", "all_", "resolved_", "filled_", "spoiled_", "kept_", "run_"))
}


# ------------------------------------------------------------------- statements
def _needed(sql: str) -> list[str]:
    """Names of the subqueries that `sql` uses, directly or not, in TABLES order."""
    found: set[str] = set()
    queue = [sql]
    while queue:
        words = set(re.findall(r"\w+", queue.pop()))
        for name in (words & TABLES.keys()) - found:
            found.add(name)
            queue.append(TABLES[name])
    return [name for name in TABLES if name in found]


def _with(sql: str) -> str:
    names = _needed(sql)
    if not names:
        return sql
    clauses = ",\n".join(f"{name} AS ({TABLES[name]})" for name in names)
    return f"WITH {clauses}\n{sql}"


def statements() -> dict[str, str]:
    simple = {name: _with(f"SELECT * FROM {name}") for name in TABLES if name not in _HELPERS}
    return {**simple, **{name: _with(sql) for name, sql in STATEMENTS.items()}}
