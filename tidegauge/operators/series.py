"""Regular time series, rolling bands and anomalies.

Series are rows after aggregation, one per time step and series key, so their length grows
with the time covered and not with the events behind them. Every series, the global one
without a key as much as one of many, is packed into blocks of time: a row per series and
block with the block's points in order. What a block needs of the others (how many points
lie before it, where the next one starts, the last few points) comes from a table with one
small row per block, joined to the blocks. So no task holds a series, and as both sides
start from the packed blocks, the input is computed once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidegauge.functions.text import clock, grouped
from tidegauge.operators.grain import seconds, span

# History needed for anomalies, wording of the alert.
MIN_POINTS = 5
ALERT = ("**Latest Anomaly Alert:** Revenue of **€%s** was detected at **%s**, "
         "which is outside the expected range.")
# Time that a block covers; points without a time are a block of their own, the first.
BLOCK = "7 days"
NO_BLOCK = -(1 << 62)


def _micros(name: str, kind: T.DataType) -> Column:
    """Microseconds since the epoch; zone-less times do not pass through the session zone."""
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), F.col(name))
    return F.unix_micros(F.col(name))


def in_blocks(rows: DataFrame, ts: str, series: Sequence[str] = (), block: str = BLOCK, context: int = 0,
              step: str | None = None) -> DataFrame:
    """A row per series and block of that length of time with its ``points`` (``at`` and the
    whole ``row``) in order, and of the series: ``before`` and ``total``, the points before
    the block and in all; ``blocks``; ``first_point`` and ``last_point``; ``next_point``, the
    first one after the block; ``recent``, the last ``context`` points before it.

    With a step, points off the grid that starts at the first point are left out.
    """
    columns, micros = rows.columns, _micros(ts, rows.schema[ts].dataType)
    number = F.coalesce(F.floor(micros / (seconds(block) * 1_000_000)).cast("bigint"), F.lit(NO_BLOCK))
    rest = micros % (seconds(step) * 1_000_000) if step else F.lit(0)
    point = F.struct(F.col(ts).alias("at"), F.struct(*columns).alias("row"))
    packed = (rows.withColumns({"__block": number, "__rest": rest})
                  .groupBy(*series, "__block", "__rest").agg(F.array_sort(F.collect_list(point)).alias("points")))

    points, n = F.col("points"), F.size("points")
    own = [*series, "__block", "__rest"]
    whole, line = Window.partitionBy(*series), Window.partitionBy(*series, "__rest").orderBy("__block")
    every = Window.partitionBy(*series, "__rest")
    each = packed.select(*own, n.alias("n"), points[0]["at"].alias("first"), points[n - 1]["at"].alias("last"),
                         F.slice(points, F.greatest(F.lit(1), n - context + 1), F.least(n, F.lit(context))).alias("tail"))
    each = each.withColumn("first_point", F.min("first").over(whole))
    if step:
        start = F.min(F.when(F.col("first") == F.col("first_point"), F.col("__rest"))).over(whole)
        each = each.withColumn("start", start).filter(F.col("__rest").eqNullSafe(F.col("start"))).drop("start")
    each = each.withColumns({
        "before": F.coalesce(F.sum("n").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "total": F.sum("n").over(every), "blocks": F.count(F.lit(1)).over(every),
        "last_point": F.max("last").over(every), "next_point": F.lead("first").over(line)})
    if context:
        # A block holds a point at least, so that many blocks hold the context.
        tails = F.flatten(F.collect_list("tail").over(line.rowsBetween(-context, -1)))
        each = each.withColumn("recent", F.slice(tails, F.greatest(F.lit(1), F.size(tails) - context + 1), context))
    each = each.drop("n", "first", "last", "tail").select(
        *[F.col(c).alias(f"of_{c}") for c in own], *[c for c in each.columns if c not in (*own, "n", "first", "last", "tail")])
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in own]
    return packed.join(each, same).drop(*[f"of_{c}" for c in own])


def densify(rows: DataFrame, step: str = "1 minute", series: Sequence[str] = (),
            ts: str = "window_start", value: str = "revenue", block: str = BLOCK) -> DataFrame:
    """A row per ``step`` from first to last point of each series, 0 where there was none.

    Times off the grid that starts at the first point are left out. Each point
    fills the gap up to the next one, so there is no calendar to build and join.
    """
    length = span(seconds(step))
    packed = in_blocks(rows.filter(F.col(ts).isNotNull()).select(*series, ts, value), ts, series, block, step=step)
    gaps = F.transform("points", lambda p, i: F.struct(
        p["at"].alias("at"), p["row"][value].alias("own"),
        F.coalesce(F.try_element_at("points", i + 2)["at"], F.col("next_point")).alias("until")))
    rows = packed.select(*series, F.explode(gaps).alias("p")).select(*series, "p.*")
    last_filled = F.greatest(F.coalesce(F.col("until") - length, F.col("at")), F.col("at"))
    return (rows.withColumn("then", F.explode(F.sequence(F.col("at"), last_filled, length)))
                .select(*series, F.col("then").alias(ts),
                        F.when(F.col("then") == F.col("at"), F.coalesce(F.col("own"), F.lit(0)))
                         .otherwise(0).cast("double").alias(value)))


def rolling_bands(rows: DataFrame, size: int = 10, deviations: float = 2.0,
                  series: Sequence[str] = (), ts: str = "window_start", value: str = "revenue",
                  exclude_current: bool = False, block: str = BLOCK) -> DataFrame:
    """Rolling mean and sample deviation, bands around the mean and the anomaly flag.

    Undefined (null) until ``size`` values are there, and then not flagged. The
    current value is part of its own mean, so its distance from it cannot exceed
    ``(size - 1) / sqrt(size)`` deviations; ``exclude_current`` compares it with the
    values before it. Series of fewer than ``MIN_POINTS`` points are left out.
    """
    frame = (-size, -1) if exclude_current else (-(size - 1), 0)
    columns, packed = rows.columns, in_blocks(rows, ts, series, block, context=size)
    packed = packed.filter(F.col("total") >= MIN_POINTS)
    own = [F.col(c).alias(f"of_{c}") for c in (*series, "__block")]
    rows = packed.select(*own, F.size("recent").alias("context"),
                         F.posexplode(F.concat("recent", "points")).alias("place", "p"))
    # Rows of a block lie together already: nothing is shuffled for these windows.
    recent = Window.partitionBy(*[f"of_{c}" for c in (*series, "__block")]).orderBy("place").rowsBetween(*frame)
    y = F.col("p")["row"][value]
    full = F.count(y).over(recent) == size
    rows = rows.withColumns({
        "rolling_mean": F.when(full, F.avg(y).over(recent)),
        "rolling_std": F.when(full, F.stddev_samp(y).over(recent)),
    })
    rows = rows.withColumns({
        "upper_band": F.col("rolling_mean") + F.col("rolling_std") * deviations,
        "lower_band": F.col("rolling_mean") - F.col("rolling_std") * deviations,
    })
    rows = rows.filter(F.col("place") >= F.col("context")).select(
        *[F.col("p")["row"][c].alias(c) for c in columns], "rolling_mean", "rolling_std", "upper_band", "lower_band")
    outside = (F.col(value) > F.col("upper_band")) | (F.col(value) < F.col("lower_band"))
    return rows.withColumn("anomaly", F.coalesce(outside, F.lit(False)))


def anomalies(bands: DataFrame, series: Sequence[str] = (), ts: str = "window_start",
              value: str = "revenue") -> DataFrame:
    return bands.filter("anomaly").select(*series, ts, F.col(value).alias("anomalous_revenue"),
                                          F.col("rolling_mean").alias("expected_revenue"))


def latest_anomaly(bands: DataFrame, series: Sequence[str] = (), ts: str = "window_start",
                   value: str = "revenue") -> DataFrame:
    """The last anomaly of each series with its alert text; no row without one."""
    newest = (anomalies(bands, series, ts, value)
              .groupBy(*series).agg(F.max_by(F.struct("*"), ts).alias("last"))
              .filter(F.col("last").isNotNull())
              .select("last.*"))
    return newest.withColumn("alert", F.format_string(
        ALERT, grouped(F.col("anomalous_revenue")), clock(F.col(ts))))
