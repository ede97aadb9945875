"""Schemas of events, catalog and served tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and types of the event message, the catalog and the
# three served tables.
EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("revenue", T.DoubleType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("source", T.StringType()),
])

CATALOG_SCHEMA = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", T.DoubleType()),
])

SERVED_SCHEMAS = {
    "trending_products": T.StructType([
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("total_events", T.LongType()),
        T.StructField("clicks", T.LongType()),
        T.StructField("purchases", T.LongType()),
        T.StructField("revenue", T.DoubleType()),
        T.StructField("total_quantity", T.LongType()),
        T.StructField("unique_users", T.IntegerType()),
        T.StructField("conversion_rate", T.DoubleType()),
        T.StructField("avg_revenue_per_event", T.DoubleType()),
        T.StructField("processed_at", T.TimestampType()),
    ]),
    "category_analytics": T.StructType([
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("category", T.StringType()),
        T.StructField("total_events", T.LongType()),
        T.StructField("clicks", T.LongType()),
        T.StructField("purchases", T.LongType()),
        T.StructField("revenue", T.DoubleType()),
        T.StructField("avg_product_price", T.DoubleType()),
        T.StructField("max_product_price_in_category", T.DoubleType()),
        T.StructField("total_quantity_sold", T.LongType()),
        T.StructField("conversion_rate", T.DoubleType()),
        T.StructField("processed_at", T.TimestampType()),
    ]),
    "user_behavior": T.StructType([
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("user_agent", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("total_events", T.LongType()),
        T.StructField("clicks", T.LongType()),
        T.StructField("purchases", T.LongType()),
        T.StructField("revenue", T.DoubleType()),
        T.StructField("unique_users_affected", T.IntegerType()),
        T.StructField("conversion_rate", T.DoubleType()),
        T.StructField("processed_at", T.TimestampType()),
    ]),
}
