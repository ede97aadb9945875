"""Sliding-window tables, built from panes in batch and on streams.

A table is a set of keys, additive measures (each an aggregate of events and the
aggregate that merges partial values) and optionally one distinct count.

Grouping each event under all its windows would multiply the input by window/slide
before anything is combined. Instead events are first combined per key and slide-long
pane. Pane rows then go to the time block(s) their windows start in, are shuffled once
by (key, block), and only there spread over windows; the final grouping needs no further
exchange. A block holds a bounded number of pane rows per key, so a hot key is no hot
task. Pane rows add up, so a stream stores those of each micro-batch and keeps no state
(see ``streaming.panes``); each has the first window it counts for, as a late event does
not reach windows that had closed when it came.

The exact distinct count never builds a set. A pane row of one key and user counts for the
windows from ``first`` to its own; taken by ``first``, each brings the user into those
windows only that lie past all panes of that user so far. These reaches are plain counts
and merge by addition. The approximate count keeps a sketch of bounded size per key and
pane instead of rows per user; sketches merge over panes and windows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidegauge.functions.rates import conversion_rate, mean_of, mean_or_zero
from tidegauge.operators.grain import REALTIME, Grain, slot_of, span, time_of
from tidegauge.schema import SERVED_SCHEMAS

EVENT_TIME = "event_timestamp"
# Base-2 logarithm of the buckets of a sketch: an error of about 1.04 / sqrt(4096).
SKETCH = 12
# Window starts per time block, as a multiple of the panes of a window: pane rows
# near a block's start are copied to the block before it, 1/6 of them.
_BLOCK_FACTOR = 6


@dataclass(frozen=True)
class Measure:
    """``update`` aggregates events; partial values merge by ``merge`` (sum, max or min)."""

    name: str
    update: str
    merge: str = "sum"
    type: str = "bigint"

    def of_events(self) -> Column:
        return F.expr(self.update).alias(self.name)

    def of_partials(self) -> Column:
        return F.expr(f"{self.merge}({self.name})").alias(self.name)


@dataclass(frozen=True)
class WindowTable:
    name: str
    keys: tuple[str, ...]
    measures: tuple[Measure, ...]
    ratios: Callable[[], dict[str, Column]]
    # (counted column, output column), a distinct count
    distinct: tuple[str, str] | None = None
    # Whether it is estimated from sketches.
    approximate: bool = False

    @property
    def columns(self) -> list[str]:
        names = SERVED_SCHEMAS[self.name].fieldNames()
        return names if self.distinct else [n for n in names if not n.startswith("unique_users")]

    def without_users(self) -> WindowTable:
        """The table less its distinct count, whose two shuffles are saved."""
        return replace(self, distinct=None)

    def with_approximate_users(self) -> WindowTable:
        """The same with the distinct count estimated, within about 2 % (one deviation of
        ``SKETCH``), which drops the shuffle by user and all rows per user."""
        return replace(self, approximate=self.distinct is not None)

    @property
    def user(self) -> str | None:
        """The column whose values pane rows are kept apart by."""
        return self.distinct[0] if self.distinct and not self.approximate else None

    @property
    def pane_measures(self) -> tuple[Measure, ...]:
        """What a pane row holds beside its keys."""
        if not self.approximate:
            return self.measures
        column, output = self.distinct
        return (*self.measures, Measure(output, f"hll_sketch_agg({column}, {SKETCH})", "hll_union_agg", "binary"))

    @property
    def measure_names(self) -> list[str]:
        """Columns that add up (or merge) across parts."""
        users = [self.distinct[1]] if self.distinct else []
        return [m.name for m in self.measures] + users

    def finish(self, rows: DataFrame) -> DataFrame:
        """Ratios, processing time and column order over whole (merged) rows."""
        if self.distinct:
            users = self.distinct[1]
            rows = rows.withColumn(users, F.col(users).cast("int"))
        return (rows.withColumns({**self.ratios(), "processed_at": F.current_timestamp()})
                    .select(*self.columns))


def _trending_ratios() -> dict[str, Column]:
    return {
        "conversion_rate": conversion_rate(F.col("purchases"), F.col("clicks")),
        "avg_revenue_per_event": mean_or_zero(F.col("revenue"), F.col("total_events")),
    }


def _category_ratios() -> dict[str, Column]:
    return {
        "conversion_rate": conversion_rate(F.col("purchases"), F.col("clicks")),
        "avg_product_price": mean_of(F.col("price_sum"), F.col("price_count")),
    }


def _behavior_ratios() -> dict[str, Column]:
    return {"conversion_rate": conversion_rate(F.col("purchases"), F.col("clicks"))}


_COUNTS = (
    Measure("total_events", "count(1)"),
    Measure("clicks", "sum(is_click)"),
    Measure("purchases", "sum(is_purchase)"),
    Measure("revenue", "sum(revenue_filled)", type="double"),
)

TRENDING_PRODUCTS = WindowTable(
    name="trending_products",
    keys=("product_id", "product_name", "category"),
    measures=(*_COUNTS, Measure("total_quantity", "sum(quantity)")),
    ratios=_trending_ratios,
    distinct=("user_id", "unique_users"),
)

CATEGORY_ANALYTICS = WindowTable(
    name="category_analytics",
    keys=("category",),
    measures=(
        *_COUNTS,
        Measure("price_sum", "sum(price)", type="double"),
        Measure("price_count", "count(price)"),
        Measure("max_product_price_in_category", "max(price)", "max", "double"),
        Measure("total_quantity_sold", "sum(quantity)"),
    ),
    ratios=_category_ratios,
)

USER_BEHAVIOR = WindowTable(
    name="user_behavior",
    keys=("user_agent", "source"),
    measures=_COUNTS,
    ratios=_behavior_ratios,
    distinct=("user_id", "unique_users_affected"),
)

TABLES = {t.name: t for t in (TRENDING_PRODUCTS, CATEGORY_ANALYTICS, USER_BEHAVIOR)}


def table_named(name: str) -> WindowTable:
    """The table of that name; an unknown name is refused before anything is planned."""
    try:
        return TABLES[name]
    except KeyError:
        raise ValueError(f"unknown table {name!r}, expected one of {sorted(TABLES)}") from None


# --- batch -------------------------------------------------------------------

def window_totals(events: DataFrame, table: WindowTable, grain: Grain = REALTIME) -> DataFrame:
    """Merged measures per window and key, without ratios. Batch only."""
    if events.isStreaming:
        raise ValueError("use streaming.panes for a streaming DataFrame")
    events = events.filter(F.col(EVENT_TIME).isNotNull())
    if grain.panes is None or grain.panes == 1:
        return _grouped_directly(events, table, grain)
    return totals_of_panes(pane_rows(events, table, grain), table, grain,
                           events.schema[EVENT_TIME].dataType)


def _grouped_directly(events: DataFrame, table: WindowTable, grain: Grain) -> DataFrame:
    """One grouping by the window itself: tumbling windows, or a slide that does not
    divide the window."""
    measures = [m.of_events() for m in table.measures]
    if table.distinct:
        column, output = table.distinct
        users = (F.hll_sketch_estimate(F.hll_sketch_agg(column, SKETCH)) if table.approximate
                 else F.count_distinct(column))
        measures.append(users.alias(output))
    rows = events.groupBy(grain.column(F.col(EVENT_TIME)), *table.keys).agg(*measures)
    return rows.select(F.col("window.start").alias("window_start"),
                       F.col("window.end").alias("window_end"),
                       *table.keys, *table.measure_names)


def pane_rows(events: DataFrame, table: WindowTable, grain: Grain, opened: int | None = None) -> DataFrame:
    """Combined measures per key, user (for an exact distinct count) and slot, the pane's
    number; ``first`` is the number of the first window they count for.

    ``opened``: the first window that is still open. Rows of several calls add up.
    """
    events = events.withColumn("pane", grain.pane(F.col(EVENT_TIME)))
    slot = slot_of("pane", events.schema["pane"].dataType, grain.slide_seconds).alias("slot")
    users = [table.user] if table.user else []
    rows = (events.groupBy(*table.keys, *users, "pane").agg(*[m.of_events() for m in table.pane_measures])
                  .select(*table.keys, *users, slot, *[m.name for m in table.pane_measures]))
    first = F.col("slot") - (grain.panes - 1)
    if opened is None:
        return rows.withColumn("first", first)
    return rows.withColumn("first", F.greatest(first, F.lit(opened))).filter("first <= slot")


def _with_reach(rows: DataFrame, table: WindowTable) -> DataFrame:
    """Rows per user combined to rows per reach, the number of windows that ``users`` of
    the slot newly enter there."""
    earlier = Window.partitionBy(*table.keys, table.user).orderBy("first", "slot").rowsBetween(
        Window.unboundedPreceding, -1)
    # Taken by first window, those before cover all from there to the latest of their slots.
    covered = F.greatest(F.max("slot").over(earlier), F.col("first") - 1)
    reach = F.when(F.col(table.user).isNull(), 0).otherwise(F.greatest(F.col("slot") - covered, F.lit(0)))
    return (rows.withColumn("reach", reach)
                .groupBy(*table.keys, "slot", "first", "reach")
                .agg(*[m.of_partials() for m in table.measures], F.count(table.user).alias("users")))


def totals_of_panes(rows: DataFrame, table: WindowTable, grain: Grain, kind: T.DataType) -> DataFrame:
    """Pane rows summed over the windows that hold them; a window goes by its first slot.

    Correct for the windows from the least slot of the rows on where earlier ones are
    left out of ``rows``."""
    if table.user:
        rows = _with_reach(rows, table)
    block = grain.panes * _BLOCK_FACTOR
    slot, first = F.col("slot"), F.col("first")
    rows = rows.withColumn("block", F.explode(F.array_distinct(F.array(
        first - F.pmod(first, F.lit(block)), slot - F.pmod(slot, F.lit(block))))))
    # A set number of partitions: what follows multiplies the rows by ``panes``, so
    # adaptive coalescing by shuffled bytes would leave too few tasks for it.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(tasks, *table.keys, "block")

    rows = rows.withColumn("opening", F.explode(F.sequence(
        F.greatest(first, F.col("block")), F.least(slot, F.col("block") + (block - 1)))))
    merges = [m.of_partials() for m in table.measures]
    if table.user:
        enters = slot - F.col("opening") < F.col("reach")
        merges.append(F.sum(F.when(enters, F.col("users")).otherwise(0))
                       .alias(table.distinct[1]))
    elif table.distinct:
        users = table.distinct[1]
        merges.append(F.hll_sketch_estimate(F.hll_union_agg(users)).alias(users))
    return (rows.groupBy(*table.keys, "block", "opening").agg(*merges)
                .withColumn("window_start", time_of("opening", kind, grain.slide_seconds))
                .withColumn("window_end", F.col("window_start") + span(grain.window_seconds))
                .select("window_start", "window_end", *table.keys, *table.measure_names))


def window_table(events: DataFrame, table: WindowTable, grain: Grain = REALTIME) -> DataFrame:
    return table.finish(window_totals(events, table, grain))


def trending_products(events: DataFrame, grain: Grain = REALTIME) -> DataFrame:
    return window_table(events, TRENDING_PRODUCTS, grain)


def category_analytics(events: DataFrame, grain: Grain = REALTIME) -> DataFrame:
    return window_table(events, CATEGORY_ANALYTICS, grain)


def user_behavior(events: DataFrame, grain: Grain = REALTIME) -> DataFrame:
    return window_table(events, USER_BEHAVIOR, grain)
