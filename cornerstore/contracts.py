"""Column contracts, payload schemas and rule lists shared by all layers."""

from __future__ import annotations

import re

from cornerstore.operators.classify import Rule
from cornerstore.schemas import schema

# Names, types and reasons that results are compared by.

SOURCE_COLUMNS = (
    "order_id", "customer_name", "product", "category", "price", "quantity", "city", "updated_at",
)

SILVER_SCHEMA = schema(
    order_id="long", customer_name="string", product="string", category="string", price="decimal(12,2)",
    quantity="int", city="string", total_amount="decimal(18,2)", source_updated_at="timestamp",
    processed_at="timestamp", source_ingested_at="timestamp", source_ingestion_date="date",
    source_batch_id="string",
)

SILVER_COLUMNS = tuple(SILVER_SCHEMA.names)

# A later row replaces an earlier one in this order.
SILVER_VERSION = ("source_updated_at", "source_ingested_at", "source_batch_id")

FINGERPRINT_COLUMNS = (
    "order_id", "customer_name", "product", "category", "price", "quantity", "city",
    "source_updated_at", "source_ingested_at", "source_ingestion_date", "source_batch_id",
)

LAKE_COLUMNS = (
    "order_id", "customer_name", "product", "category", "price", "quantity", "city",
    "order_date", "updated_at",
)

SALES_SCHEMA = schema(
    order_id="int", customer_name="string", product="string", category="string",
    price="int", quantity="int", city="string",
)

ORDER_EVENT_SCHEMA = schema(
    order_id="string", customer_id="string", customer_name="string", customer_email="string",
    product_id="string", product_name="string", category="string", store_id="string",
    order_timestamp="string", updated_at="string", quantity="int", unit_price="double",
    operation="string",
)

ALLOWED_OPERATIONS = "operation IN ('INSERT', 'UPDATE', 'DELETE')"

EVENT_REQUIRED_COLUMNS = (
    "order_id", "customer_id", "product_id", "order_timestamp", "quantity", "unit_price",
)

MEDALLION_RULES = (
    Rule("order_id_is_null", "order_id IS NULL"),
    Rule("customer_name_is_blank", "customer_name IS NULL OR customer_name = ''"),
    Rule("product_is_blank", "product IS NULL OR product = ''"),
    Rule("category_is_blank", "category IS NULL OR category = ''"),
    Rule("city_is_blank", "city IS NULL OR city = ''"),
    Rule("price_is_null", "price IS NULL"),
    Rule("price_is_negative", "price < 0"),
    Rule("quantity_is_null", "quantity IS NULL"),
    Rule("quantity_is_not_positive", "quantity <= 0"),
    Rule("updated_at_is_null", "source_updated_at IS NULL"),
)

# Off by default: rejects rows whose amount does not fit decimal(18,2).
AMOUNT_RULE = Rule("total_amount_is_null", "total_amount IS NULL")

LAKE_RULES = (
    Rule("missing_order_id", "order_id IS NULL"),
    Rule("blank_customer", "customer_name IS NULL OR customer_name = ''"),
    Rule("blank_product", "product IS NULL OR product = ''"),
    Rule("invalid_price", "price IS NULL OR price < 0"),
    Rule("invalid_quantity", "quantity IS NULL OR quantity <= 0"),
    Rule("missing_order_date", "order_date IS NULL"),
    Rule("missing_updated_at", "updated_at IS NULL"),
)

EVENT_RULES = (
    Rule(
        "missing_required_field",
        " OR ".join(f"{name} IS NULL" for name in EVENT_REQUIRED_COLUMNS),
    ),
    Rule("non_positive_quantity", "quantity <= 0"),
    Rule("negative_unit_price", "unit_price < 0"),
)

SILVER_RULES = (
    "order_id IS NULL",
    *(f"{name} IS NULL OR trim({name}) = ''" for name in ("customer_name", "product", "category", "city")),
    "price IS NULL OR price < 0",
    "quantity IS NULL OR quantity <= 0",
    "source_updated_at IS NULL",
)

KPI_COLUMNS = (
    "total_revenue", "order_count", "units_sold", "average_order_value",
    "distinct_customers", "last_refreshed_at",
)

# dataset -> (serving table, key columns, published columns)
GOLD_TARGETS = {
    "overall_sales": ("analytics_overall_sales", ("metric_scope",), ("metric_scope", *KPI_COLUMNS)),
    "category_sales": ("analytics_category_sales", ("category",), ("category", *KPI_COLUMNS)),
    "city_sales": ("analytics_city_sales", ("city",), ("city", *KPI_COLUMNS)),
    "product_sales": (
        "analytics_product_sales", ("product", "category"), ("product", "category", *KPI_COLUMNS),
    ),
    "top_products": (
        "analytics_top_products", ("product", "category"),
        ("sales_rank", "product", "category", "total_revenue", "order_count", "units_sold",
         "average_order_value", "last_refreshed_at"),
    ),
    "customer_sales": (
        "analytics_customer_sales", ("customer_name",),
        ("customer_name", *KPI_COLUMNS, "distinct_products"),
    ),
}

RECONCILED_DATASETS = ("category_sales", "city_sales", "product_sales", "customer_sales")

OVERALL_SCOPE = "all_retail_sales"

BATCH_ID_PATTERN = re.compile(r"[A-Za-z0-9_-]+")


def check_batch_id(batch_id: str) -> str:
    if not BATCH_ID_PATTERN.fullmatch(batch_id):
        raise ValueError(f"batch id may hold only letters, digits, '_' and '-': {batch_id!r}")
    return batch_id
