"""Per-event columns and the catalog join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def with_event_flags(events: DataFrame, event_time: Column | None = None) -> DataFrame:
    """Add ``event_timestamp``, ``is_purchase``, ``is_click`` and ``revenue_filled``.

    A time text that does not parse gives a null time, which every window drops.
    """
    if event_time is None:
        event_time = F.try_to_timestamp(F.col("timestamp"))
    return events.withColumns({
        "event_timestamp": event_time,
        "is_purchase": F.when(F.col("event_type") == "purchase", 1).otherwise(0),
        "is_click": F.when(F.col("event_type") == "click", 1).otherwise(0),
        "revenue_filled": F.coalesce("revenue", F.lit(0.0)),
    })


def purchase_revenue(event_type: Column, price: Column, quantity: Column) -> Column:
    """Price times quantity in cents for purchases, null for anything else."""
    return F.when(event_type == "purchase", F.round(price * quantity, 2))


def with_catalog(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """Copy name, category and list price onto each event; unknown products stay, with nulls.

    No join hint: Spark broadcasts a catalog that its size statistics show to be under
    ``autoBroadcastJoinThreshold`` and otherwise sort-merges, where AQE splits the
    partitions of hot products.
    """
    return events.join(catalog, "product_id", "left")
