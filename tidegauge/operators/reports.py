"""Reports over the window tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegauge.functions.rates import funnel_rate, overall_rate
from tidegauge.functions.text import clock, grouped, label, spaced, title_case, whole_grouped
from tidegauge.operators.latest import at_latest_window

# The wording of the reports.
NO_INSIGHT = "Not enough data for an insight."
INSIGHT_HIGH = "**Top Performer:** `%s` is leading with **%s** in %s."
INSIGHT_LOW = "**Top Performer:** `%s` is performing best with the lowest %s of **%s**."
NO_VALUE = "N/A"
SNAPSHOT_TITLE = "Live Snapshot (Window starting at %s)"
TOP_CHANNEL = "The **%s** channel is currently driving the most revenue."
TOP_CATEGORY = "**%s** is the highest-earning product category right now."


def _first(ties: Sequence[str], metric: str, highest: bool = True) -> Column:
    """The row with the highest (lowest) metric as a struct; ties go to the smaller text."""
    value = F.round(F.col(metric).cast("double"), 6)
    order = F.struct((-value if highest else value).alias("rank"),
                     *[F.coalesce(F.col(t), F.lit("")).alias(f"tie_{t}") for t in ties])
    return F.min_by(F.struct("*"), F.when(F.col(metric).isNotNull(), order))


def top_row_value(rows: DataFrame, attribute: str, metric: str = "revenue",
                  ties: Sequence[str] = (), alias: str | None = None) -> DataFrame:
    """``attribute`` of the single row with most ``metric``, ``N/A`` without rows.

    An argmax over rows, not over sums per attribute.
    """
    best = _first([*ties] or [attribute], metric)
    return rows.agg(best.alias("best")).select(
        F.coalesce(F.col(f"best.{attribute}"), F.lit(NO_VALUE)).alias(alias or attribute))


def _totals() -> list[Column]:
    return [F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("total_revenue"),
            F.coalesce(F.sum("purchases"), F.lit(0)).alias("total_purchases"),
            F.coalesce(F.sum("clicks"), F.lit(0)).alias("total_clicks")]


def _overall() -> Column:
    return overall_rate(F.col("total_purchases"), F.col("total_clicks"))


def kpi_snapshot(products: DataFrame, behavior: DataFrame) -> DataFrame:
    """Totals of the products at the latest window of the behavior table."""
    return (at_latest_window(products, of=behavior).agg(*_totals())
            .withColumn("overall_conversion_rate", _overall()))


def overview(products: DataFrame, behavior: DataFrame) -> DataFrame:
    """The snapshot with top channel and category, as one row of values and display text.

    One pass over each table's latest window; the behavior side comes in as one
    scalar struct.
    """
    by_channel = at_latest_window(behavior).agg(F.struct(
        F.max("window_start").alias("window_start"),
        _first(("user_agent", "source"), "revenue").alias("best")).alias("latest"))
    kpis = (at_latest_window(products, of=behavior)
            .agg(*_totals(),
                 _first(("product_id", "product_name", "category"), "revenue").alias("best"))
            .withColumn("latest", by_channel.scalar())
            .withColumns({
                "overall_conversion_rate": _overall(),
                "window_start": F.col("latest.window_start"),
                "top_channel": F.coalesce(F.col("latest.best.source"), F.lit(NO_VALUE)),
                "top_category": F.coalesce(F.col("best.category"), F.lit(NO_VALUE)),
            }).drop("latest", "best"))
    return kpis.withColumns({
        "title": F.format_string(SNAPSHOT_TITLE, clock(F.col("window_start"))),
        "revenue_text": F.concat(F.lit("€"), grouped(F.col("total_revenue"))),
        "purchases_text": whole_grouped(F.col("total_purchases")),
        "conversion_text": F.concat(F.format_string("%.2f", "overall_conversion_rate"), F.lit("%")),
        "channel_text": F.format_string(TOP_CHANNEL, title_case(F.col("top_channel"))),
        "category_text": F.format_string(TOP_CATEGORY, title_case(F.col("top_category"))),
    })


def performer_insight(rows: DataFrame, metric: str, entity: str,
                      high_is_good: bool = True) -> DataFrame:
    """Best and worst entity by ``metric`` and a sentence on the best; one row always."""
    both = rows.agg(_first([entity], metric, high_is_good).alias("top"),
                    _first([entity], metric, not high_is_good).alias("worst"))
    value = grouped(F.col(f"top.{metric}").cast("double"))
    name = F.col(f"top.{entity}")
    if high_is_good:
        sentence = F.format_string(INSIGHT_HIGH, name, value, spaced(F.lit(metric)))
    else:
        sentence = F.format_string(INSIGHT_LOW, name, F.lit(metric), value)
    return both.select(
        name.alias("top_entity"),
        F.col(f"top.{metric}").cast("double").alias("top_value"),
        F.col(f"worst.{entity}").alias("worst_entity"),
        F.col(f"worst.{metric}").cast("double").alias("worst_value"),
        F.when(F.col("top").isNull(), F.lit(NO_INSIGHT)).otherwise(sentence).alias("insight"),
    )


def top_k(rows: DataFrame, metric: str, k: int = 10,
          ties: Sequence[str] = ("product_id", "product_name", "category"),
          per: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows with the highest metric, overall or ``per`` group; nulls rank nowhere."""
    order = [F.desc(metric), *[F.asc(t) for t in ties]]
    rows = rows.filter(F.col(metric).isNotNull())
    if not per:
        return rows.orderBy(*order).limit(k)
    place = F.row_number().over(Window.partitionBy(*per).orderBy(*order))
    return rows.withColumn("place", place).filter(F.col("place") <= k)


def revenue_per_window(products: DataFrame) -> DataFrame:
    """Revenue of all products per window."""
    return (products.filter(F.col("window_start").isNotNull())
                    .groupBy("window_start").agg(F.sum("revenue").alias("revenue")))


def revenue_trend(products: DataFrame) -> DataFrame:
    """As :func:`revenue_per_window`, in time order."""
    return revenue_per_window(products).orderBy("window_start")


def product_names(products: DataFrame) -> DataFrame:
    return products.select("product_name").distinct().orderBy("product_name")


def first_two_names(products: DataFrame) -> tuple[Column, Column]:
    """The first two product names in order, as scalar subqueries; one name stands twice."""
    first = products.agg(F.min("product_name")).scalar()
    second = products.filter(F.col("product_name") > first).agg(F.min("product_name")).scalar()
    return first, F.coalesce(second, first)


def compare_products(products: DataFrame, first: str | Column, second: str | Column,
                     metric: str = "purchases") -> DataFrame:
    """``metric`` of two products side by side, one row per window with either of them.

    A product without rows in a window counts 0 there; a name carried by several product
    ids counts with all of them. One pass and one grouping, no join.
    """
    first, second = (F.lit(n) if isinstance(n, str) else n for n in (first, second))
    name = F.col("product_name")

    def total(of: Column) -> Column:
        return F.coalesce(F.sum(F.when(name == of, F.col(metric))), F.lit(0))

    return (products.filter((name == first) | (name == second))
                    .groupBy("window_start").agg(total(first).alias("product_1"), total(second).alias("product_2"))
                    .orderBy("window_start"))


def revenue_rollup(products: DataFrame) -> DataFrame:
    """Revenue of everything (level 0), per category (1) and per product name (2)."""
    leaves = (products.groupBy("category", "product_name")
                      .agg(F.sum("revenue").alias("revenue")))
    return (leaves.rollup("category", "product_name")
                  .agg(F.sum("revenue").alias("revenue"), F.grouping_id().alias("rolled"))
                  .select((F.lit(2) - F.bit_count("rolled")).alias("level"),
                          "category", "product_name", "revenue"))


def revenue_share(categories: DataFrame) -> DataFrame:
    """Part of each window's revenue per category; null where a window has none."""
    whole = F.sum("revenue").over(Window.partitionBy("window_start"))
    return (categories.groupBy("window_start", "category").agg(F.sum("revenue").alias("revenue"))
                      .withColumn("share", F.when(whole != 0, F.col("revenue") / whole)))


def conversion_rank(categories: DataFrame) -> DataFrame:
    return (categories.select("window_start", "category", "conversion_rate")
                      .orderBy(F.desc("conversion_rate"), "category"))


def channel_funnel(behavior: DataFrame) -> DataFrame:
    """Clicks, purchases and their rate per source; rows without a source are left out."""
    return (behavior.filter(F.col("source").isNotNull())
                    .groupBy("source")
                    .agg(F.sum("clicks").alias("clicks"), F.sum("purchases").alias("purchases"))
                    .withColumn("conversion_rate",
                                funnel_rate(F.col("purchases"), F.col("clicks"))))


def channel_revenue(behavior: DataFrame) -> DataFrame:
    """Revenue per window and source, long form."""
    return (behavior.na.drop(subset=["window_start", "source"])
                    .groupBy("window_start", "source").agg(F.sum("revenue").alias("revenue")))


def channel_revenue_pivot(behavior: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Revenue per window with one column per source, 0 where a source has none.

    The sources are passed, so the schema does not depend on the data and no extra
    job looks for them.
    """
    return (behavior.na.drop(subset=["window_start", "source"])
                    .groupBy("window_start").pivot("source", list(sources)).agg(F.sum("revenue"))
                    .na.fill(0.0, list(sources))
                    .orderBy("window_start"))


def metric_labels(rows: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column with their display labels."""
    return (rows.select(column).distinct()
                .select(column, title_case(F.col(column)).alias("title"),
                        label(F.col(column)).alias("label")))
