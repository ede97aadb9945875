"""Events from the general-purpose test tables.

``events(event_id, ts, user_id, event_type, value, props)`` and ``part`` take the
shape of commerce events: ``props.k`` is the product, joined to ``part`` for name and
category, ``value`` the price; quantity, device and channel follow from the ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegauge.functions.text import iso_time
from tidegauge.operators.events import purchase_revenue, with_event_flags
from tidegauge.sources.catalog import catalog_from_parts
from tidegauge.sources.decode import decode_messages
from tidegauge.sources.messages import parquet_stream
from tidegauge.streaming.publish import to_messages

EVENTS_DDL = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string")
DEVICES = ("mobile", "desktop", "tablet")
SOURCES = ("organic", "paid_search", "social", "email", "direct")


def _pick(options: tuple[str, ...], number: str) -> Column:
    return F.array(*map(F.lit, options))[(F.col(number) % len(options)).cast("int")]


def adapt(events: DataFrame, parts: DataFrame) -> DataFrame:
    events = events.select(
        F.col("event_id").cast("string").alias("event_id"),
        "ts",
        F.format_string("user_%03d", "user_id").alias("user_id"),
        "event_type",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.col("value").alias("price"),
        (F.col("event_id") % 3 + 1).cast("int").alias("quantity"),
        _pick(DEVICES, "user_id").alias("user_agent"),
        _pick(SOURCES, "event_id").alias("source"),
    )
    return (events.join(catalog_from_parts(parts), "k", "left")
                  .withColumns({
                      "product_id": F.concat(F.lit("SKU_"), F.col("k").cast("string")),
                      "timestamp": iso_time(F.col("ts")),
                      "revenue": purchase_revenue(F.col("event_type"), F.col("price"),
                                                  F.col("quantity")),
                  })
                  .drop("k"))


def read_parts_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapt(spark.read.parquet(f"{sf_dir}/events.parquet"), read_parts_table(spark, sf_dir))


def shop_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded events with their derived columns."""
    return with_event_flags(raw_events(spark, sf_dir), F.col("ts"))


def message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of keyed JSON messages."""
    stream = parquet_stream(spark, f"{sf_dir}/events.parquet", EVENTS_DDL)
    return to_messages(adapt(stream, read_parts_table(spark, sf_dir)))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream decoded from its messages, as a consumer sees it."""
    return decode_messages(message_stream(spark, sf_dir))
