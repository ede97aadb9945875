"""The latest window of a table, and the events under it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidegauge.operators.grain import REALTIME, Grain, span
from tidegauge.operators.windowed import EVENT_TIME, WindowTable, window_totals


def latest_window_start(table: DataFrame, complete_only: bool = False) -> DataFrame:
    """One row, ``window_start``: the newest window (null on an empty table).

    Windows slide, so the newest has just opened and holds one slide of events.
    ``complete_only`` takes the newest that had ended when it opened.
    """
    newest = table.agg(F.max("window_start").alias("window_start"))
    if complete_only:
        newest = (table.filter(F.col("window_end") <= newest.scalar())
                       .agg(F.max("window_start").alias("window_start")))
    return newest


def at_latest_window(table: DataFrame, of: DataFrame | None = None,
                     complete_only: bool = False) -> DataFrame:
    """Rows of ``table`` at the latest window of ``of`` (default: its own).

    A scalar subquery: over a stored table its value is pushed to the scan, and
    nothing passes through the driver. ``table`` lagging behind ``of`` gives no rows.
    """
    latest = latest_window_start(table if of is None else of, complete_only)
    return table.filter(F.col("window_start") == latest.scalar())


def events_in_latest_window(events: DataFrame, grain: Grain) -> DataFrame:
    """Events of the newest window, which opened with the last event's pane.

    The bound reaches the scan as a filter on event time.
    """
    newest = (events.agg(F.max(EVENT_TIME).alias("newest"))
                    .select(grain.pane(F.col("newest")).alias("start")))
    return events.filter(F.col(EVENT_TIME) >= newest.scalar())


def latest_window_table(events: DataFrame, table: WindowTable, grain: Grain = REALTIME) -> DataFrame:
    """The newest window of a table straight from events.

    Same rows as ``at_latest_window(window_table(...))``, but older windows are never
    built: it reads the tail of the events and groups them once, by key.
    """
    tail = events_in_latest_window(events, grain)
    totals = window_totals(tail, table, Grain(f"{grain.slide_seconds} seconds", None))
    opened_until = F.col("window_start") + span(grain.window_seconds)
    return table.finish(totals.withColumn("window_end", opened_until))
