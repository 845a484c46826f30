"""Fixed values.

Everything in this module is a value that results depend on: code lists, column
lists, labels, dates and limits of the e-commerce model.  They are data, not
logic, and are kept together so that they can be compared with the model's
documentation at a glance.
"""

# --------------------------------------------------------------- code lists
STATE_CODES = (
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT", "PA",
    "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO",
)
ORDER_STATUSES = (
    "approved", "canceled", "created", "delivered",
    "invoiced", "processing", "shipped", "unavailable",
)
PAYMENT_TYPES = ("boleto", "credit_card", "debit_card", "not_defined", "voucher")

# Orders in these states never set a price, so the baseline leaves them out.
NO_SALE_STATUSES = ("canceled", "unavailable")

# ------------------------------------------------------------------- limits
ZIP_RANGE = (1000, 99999)
SCORE_RANGE = (1, 5)
ID_LENGTH = 32
HEX_ID = r"^[0-9a-f]{32}$"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# ------------------------------------------------- column lists, by table
CUSTOMER_COLUMNS = (
    "customer_id", "customer_unique_id", "customer_zip_code_prefix",
    "customer_city", "customer_state",
)
SELLER_COLUMNS = ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")
ORDER_TIMES = (
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
)
ORDER_COLUMNS = ("order_id", "customer_id", "order_status", *ORDER_TIMES)
ITEM_COLUMNS = (
    "order_id", "order_item_id", "product_id", "seller_id",
    "shipping_limit_date", "price", "freight_value",
)
PAYMENT_TYPES_BY_COLUMN = {
    "order_id": "string",
    "payment_sequential": "int",
    "payment_type": "string",
    "payment_installments": "int",
    "payment_value": "double",
}
PAYMENT_COLUMNS = tuple(PAYMENT_TYPES_BY_COLUMN)
# Two headers are misspelt in the source files.
PRODUCT_RENAMES = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
}
PRODUCT_MEASURES = (
    "product_name_length", "product_description_length", "product_photos_qty",
    "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
)
PRODUCT_COLUMNS = ("product_id", "product_category_name", *PRODUCT_MEASURES)
REVIEW_KEYS = (
    "review_id", "order_id", "review_score",
    "review_creation_date", "review_answer_timestamp",
)
REVIEW_COLUMNS = (
    "review_id", "order_id", "review_score", "review_comment_title",
    "review_comment_message", "review_creation_date", "review_answer_timestamp",
)
CATEGORY_COLUMNS = ("product_category_name", "product_category_name_english")

DIM_CUSTOMER_COLUMNS = (
    "customer_key", "customer_unique_id", "first_order_date", "state", "city",
)
DIM_DATE_COLUMNS = (
    "date_key", "date", "year", "month", "dow", "is_black_friday", "event_window",
    "is_weekend", "event_period", "event_period_sort", "period_group", "period_group_sort",
)
DIM_PRODUCT_COLUMNS = (
    "product_key", "product_id", "category_pt", "category_en",
    "weight_g", "length_cm", "height_cm", "width_cm", "baseline_price_med",
)
DIM_SELLER_COLUMNS = ("seller_key", "seller_id", "seller_state", "seller_city")
FACT_ORDER_COLUMNS = (
    "order_id", "date_key", "customer_key", "order_value",
    "item_count", "delivery_delay_days", "payment_value_total", "is_new_at_order",
)
FACT_ITEM_COLUMNS = (
    "order_item_id", "order_id", "date_key", "customer_key", "product_key",
    "seller_key", "price", "freight_value", "price_vs_baseline_pct",
)
FACT_REVIEW_COLUMNS = ("review_id", "order_id", "order_date_key", "review_score")

# ------------------------------------------------------------ placeholders
NO_TITLE = "No title"
NO_MESSAGE = "No comment"
UNKNOWN_CATEGORY = "unknown"

# Categories that the published translation list lacks, with their English names.
CATEGORY_PATCH = (
    ("pc gamer", "PC Gamer"),
    (
        "portateis cozinha e preparadores de alimentos",
        "Food Processors And Portable Kitchen Appliances",
    ),
)
KNOWN_UNTRANSLATED = tuple(key for key, _ in CATEGORY_PATCH)

# ---------------------------------------------------------------- calendar
CALENDAR_START = "2016-01-01"
CALENDAR_END = "2018-12-31"
STUDY_YEAR = 2017
EVENT_WINDOW_DAYS = 7
BEFORE_DAYS = 28
EVENT_DAYS = 3
AFTER_DAYS = 28
# Downstream reports match these labels letter by letter.
WEEKEND_LABELS = ("Weekend", "Weekday")
BLACK_FRIDAY_LABELS = ("Black Friday", "Other Day")
WINDOW_LABELS = ("Within 7 days of Black Friday", "More than 7 days away")
PERIOD_LABELS = ("Pre 28 days", "Black Friday 3 days", "Post 28 days", "Other days")
GROUP_LABELS = ("Black Friday", "Baseline", "Other days")

# ---------------------------------------------------------- quality logging
STAGE_BEFORE = "silver_before_clean"
STAGE_AFTER = "silver_after_clean"
ROWCOUNT_LOG_SCHEMA = (
    "dataset string, stage string, row_count bigint, log_timestamp timestamp"
)
INVALID_SUMMARY_SCHEMA = "dataset string, invalid_rows bigint, log_timestamp timestamp"
INVALID_ROWS_SCHEMA = (
    "dataset string, column_name string, rule string, "
    "invalid_value string, log_timestamp timestamp"
)
SUMMARY_SCHEMA = (
    "dataset string, silver_before bigint, silver_after bigint, dropped_rows bigint, "
    "invalid_rows bigint, dq_pass boolean, log_timestamp timestamp"
)

# ------------------------------------------------------------- table names
SILVER_TABLES = {
    "customers": "silver_customers",
    "sellers": "silver_sellers",
    "orders": "silver_orders",
    "order_items": "silver_order_items",
    "order_payments": "silver_order_payments",
    "products": "silver_products",
    "order_reviews": "silver_order_reviews",
    "product_category": "silver_product_category_name",
}
GOLD_TABLES = {
    "dim_customer": "gold_dim_customer",
    "dim_date": "gold_dim_date",
    "dim_product": "gold_dim_product",
    "dim_seller": "gold_dim_seller",
    "fact_order": "gold_fact_order",
    "fact_order_item": "gold_fact_order_item",
    "fact_review": "gold_fact_review",
}
LOG_TABLES = {
    "rowcount": "dq_rowcount_logs",
    "invalid_summary": "dq_invalid_summary_logs",
    "invalid_rows": "dq_invalid_row_logs",
    "summary": "dq_summary",
}

# Names under which the review validator reports its checks.
REVIEW_CHECKS = {
    "columns": "required_columns_present",
    "created_type": "creation_date_is_timestamp",
    "answered_type": "answer_timestamp_is_timestamp",
    "score_type": "score_is_int",
    "keys": "no_nulls_in_key_columns",
    "comments": "comments_filled",
    "score": "score_between_1_and_5",
    "unique": "review_order_key_unique",
    "order": "answer_after_creation",
    "line_breaks": "no_line_breaks_in_comments",
    "one_per_order": "one_review_per_order",
    "orders_exist": "order_ids_exist_in_orders",
}
