"""Star-schema building and data-quality rules on Spark; see README.md."""

from orrery.operators.quality_log import (
    dq_summary,
    generate_dq_summary,
    log_invalid_rows,
    log_invalid_summary,
    log_row_count,
)
from orrery.operators.rules import Report, RuleSet, RuleViolation
from orrery.plans.checks import (
    ValidationError,
    all_passed,
    assert_valid,
    print_report,
    validate_category_dataframe,
    validate_category_translation,
    validate_customers,
    validate_customers_gold,
    validate_date_gold,
    validate_dim_customer_gold,
    validate_dim_date_gold,
    validate_dim_product_gold,
    validate_dim_seller_gold,
    validate_fact_order_item_gold,
    validate_fact_orders_gold,
    validate_fact_review_gold,
    validate_order_item_gold,
    validate_order_items,
    validate_order_payments,
    validate_orders,
    validate_orders_gold,
    validate_product_gold,
    validate_products,
    validate_review_gold,
    validate_reviews,
    validate_seller_gold,
    validate_sellers,
)
from orrery.plans.dims import (
    add_category_english,
    add_date_attributes,
    build_dim_customer,
    build_dim_date,
    build_dim_date_covering,
    build_dim_product,
    build_dim_product_gold,
    clean_customers_gold,
    clean_dim_seller_gold,
    clean_sellers_gold,
    compute_baseline_price,
)
from orrery.plans.facts import (
    build_fact_order_item_gold,
    build_fact_order_items_gold,
    build_fact_orders_gold,
    build_fact_review_gold,
    clean_fact_order_item,
    clean_fact_order_item_gold,
    clean_fact_orders_gold,
    clean_fact_review_gold,
)
from orrery.plans.runs import clean_order_payments_path
from orrery.plans.silver import (
    aggregate_order_payment_totals,
    clean_category_dataframe,
    clean_category_translation,
    clean_customers,
    clean_order_items,
    clean_order_payments,
    clean_orders,
    clean_products,
    clean_reviews,
    clean_sellers,
    latest_review_per_order,
    quarantine,
    remove_duplicates,
    sanitize_category_name,
    standardise_reviews,
)
from orrery.session import get_session
from orrery.sources.files import load_reviews, read_raw_order_payments

__all__ = [name for name in dir() if not name.startswith("_")]
