"""Schemas and fixed values of the event, mart and price contracts."""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StringType, StructField, StructType, TimestampType

# fixed values: event types, their aliases and keys
ALIASES = {"page_view": "view", "add_to_cart": "cart"}
TYPE_KEYS = {"view": 1, "cart": 2, "purchase": 3}

WIRE_SCHEMA = StructType([
    StructField(n, DoubleType() if n == "price" else StringType())
    for n in ("event_time", "event_type", "product_id", "category_id", "category_code", "brand", "price", "user_id", "user_session")
])

PRICE_SCHEMA = StructType([
    StructField("snapshot_time", TimestampType()),
    *(StructField(n, StringType()) for n in ("site", "product_id", "product_name", "category_path", "brand")),
    *(StructField(n, DoubleType()) for n in ("price", "list_price")),
    StructField("currency", StringType()), StructField("rating", DoubleType()), StructField("review_count", IntegerType()),
    StructField("seller_name", StringType()), StructField("in_stock", BooleanType()), StructField("url", StringType()),
])

# fixed values: the columns of each published mart, in order, and its key
MART_COLUMNS = {
    "funnel_daily": "event_date viewers cart_users buyers view_to_cart_rate cart_to_purchase_rate conversion_rate cart_abandonment_rate".split(),
    "product_daily": "event_date product_id brand category_code views cart_adds purchase_events revenue view_to_cart_rate cart_to_purchase_rate".split(),
    "category_daily": "event_date category_code views cart_adds purchase_events revenue conversion_rate".split(),
    "daily_revenue": "event_date revenue purchase_events buyers avg_purchase_value".split(),
    "session_daily": "event_date session_id user_id session_start session_end duration_seconds event_count product_count view_count cart_count purchase_count session_outcome".split(),
}
MART_KEYS = {
    "funnel_daily": ["event_date"], "product_daily": ["event_date", "product_id"], "category_daily": ["event_date", "category_code"],
    "daily_revenue": ["event_date"], "session_daily": ["session_id"],
}
