"""Named queries over the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidegauge.operators import reports, series
from tidegauge.operators.forecast import forecast, forecast_summary, history
from tidegauge.operators.grain import HOURLY, Grain
from tidegauge.operators.latest import at_latest_window, latest_window_table
from tidegauge.operators.windowed import (
    CATEGORY_ANALYTICS, SKETCH, TABLES, TRENDING_PRODUCTS, USER_BEHAVIOR, WindowTable, window_table, window_totals)
from tidegauge.operators.events import with_catalog
from tidegauge.plans.adapter import SOURCES, event_stream, raw_events, read_parts_table, shop_events
from tidegauge.sources.catalog import read_catalog
from tidegauge.session import tune
from tidegauge.settings import Settings, shared_root
from tidegauge.sources.decode import decode_messages, rejected_messages
from tidegauge.streaming import jobs, panes, serving, toplist
from tidegauge.streaming.publish import to_messages

Query = Callable[[SparkSession, str], DataFrame]

# The test events are sparse: reports on one window use a week sliding by a day,
# time series one-hour windows.
WEEKLY = Grain("7 days", "1 day")
DECIMALS = {
    "revenue": 2, "total_revenue": 2, "anomalous_revenue": 2, "overall_conversion_rate": 4,
    "share": 6, "rolling_mean": 4, "rolling_std": 4, "upper_band": 4, "lower_band": 4,
    "expected_revenue": 4, "predicted_revenue": 4, "top_value": 2, "worst_value": 2,
}

QUERIES: dict[str, Query] = {}


def result(rows: DataFrame) -> DataFrame:
    """Comparable columns: zone-less times, sums cut to where any order of adding agrees."""
    columns = []
    for field in rows.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        if field.name in DECIMALS:
            column = F.round(column.cast("double"), DECIMALS[field.name])
        if field.name != "processed_at":
            columns.append(column.alias(field.name))
    return rows.select(*columns)


def query(build: Query) -> Query:
    """Register under the function's name."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return result(build(tune(spark), sf_dir))

    run.__name__ = build.__name__
    QUERIES[build.__name__] = run
    return run


def fresh_root(spark: SparkSession) -> str:
    return f"{shared_root(spark).rstrip('/')}/tidegauge/{uuid.uuid4().hex}"


# --- events ------------------------------------------------------------------

def _messages_with_rubbish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a message, and thrice more: cut short, with a bad time, empty."""
    good = to_messages(raw_events(spark, sf_dir))
    cut = F.substring("value", F.lit(1), (F.length("value") / 2).cast("int"))
    bad_time = F.regexp_replace("value", r'"timestamp":"[^"]*"', '"timestamp":"soon"')
    return good.withColumn("value", F.explode(F.array("value", cut, bad_time, F.lit(""))))


@query
def decoded_events(spark, sf_dir):
    events = decode_messages(_messages_with_rubbish(spark, sf_dir))
    return events.filter(F.col("event_timestamp").isNotNull()).select(
        "event_id", "event_timestamp", "user_id", "event_type", "product_id", "product_name",
        "category", "price", "quantity", "revenue", "user_agent", "source")


@query
def rejected_events(spark, sf_dir):
    return (rejected_messages(_messages_with_rubbish(spark, sf_dir))
            .groupBy("key", "reason").agg(F.count(F.lit(1)).alias("messages")))


@query
def event_flags(spark, sf_dir):
    return shop_events(spark, sf_dir).select("event_id", "event_type", "is_purchase", "is_click",
                                             "revenue_filled")


@query
def event_revenue(spark, sf_dir):
    return raw_events(spark, sf_dir).select("event_id", "event_type", "price", "quantity",
                                            F.col("revenue").alias("event_revenue"))


@query
def catalog_enrichment(spark, sf_dir):
    return raw_events(spark, sf_dir).select("event_id", "product_id", "product_name", "category")


@query
def catalog_join(spark, sf_dir):
    """Events against a stored catalog made from the parts, name, category and price from it."""
    path = f"{fresh_root(spark)}/catalog"
    parts = read_parts_table(spark, sf_dir)
    parts.select(F.concat(F.lit("SKU_"), F.col("p_partkey").cast("string")).alias("product_id"),
                 F.col("p_name").alias("product_name"), F.col("p_type").alias("category"),
                 F.col("p_retailprice").alias("price")).write.parquet(path)
    bare = raw_events(spark, sf_dir).select("event_id", "product_id")
    return with_catalog(bare, read_catalog(spark, path)).withColumnRenamed("price", "list_price")


@query
def publish_payload(spark, sf_dir):
    messages = to_messages(raw_events(spark, sf_dir))
    fields = ("event_id", "timestamp", "user_id", "event_type", "product_id")
    return messages.select(
        "key", *[F.get_json_object("value", f"$.{f}").alias(f) for f in fields],
        F.get_json_object("value", "$.price").cast("double").alias("price"),
        F.get_json_object("value", "$.revenue").cast("double").alias("event_revenue"),
        F.get_json_object("value", "$.quantity").cast("int").alias("quantity"))


# --- window tables -----------------------------------------------------------

@query
def trending_products(spark, sf_dir):
    return window_table(shop_events(spark, sf_dir), TRENDING_PRODUCTS)


@query
def category_analytics(spark, sf_dir):
    return window_table(shop_events(spark, sf_dir), CATEGORY_ANALYTICS)


@query
def user_behavior(spark, sf_dir):
    return window_table(shop_events(spark, sf_dir), USER_BEHAVIOR)


def _served_from_stream(spark: SparkSession, sf_dir: str, table: WindowTable) -> DataFrame:
    """All files in one go, so no event is late and the table equals the batch one."""
    root = fresh_root(spark)
    jobs.finish([jobs.start_serving(event_stream(spark, sf_dir), [table], root, available_now=True)])
    rows = panes.read_latest(spark, f"{root}/serving", table, ttl=None)
    return rows.select(*table.columns)


@query
def trending_products_stream(spark, sf_dir):
    return _served_from_stream(spark, sf_dir, TRENDING_PRODUCTS)


@query
def category_analytics_stream(spark, sf_dir):
    return _served_from_stream(spark, sf_dir, CATEGORY_ANALYTICS)


@query
def user_behavior_stream(spark, sf_dir):
    return _served_from_stream(spark, sf_dir, USER_BEHAVIOR)


@query
def top_products_kept(spark, sf_dir):
    """The five best products of each week, kept while the events come in three deliveries."""
    root = fresh_root(spark)
    settings = Settings(window=WEEKLY.window, slide=WEEKLY.slide, watermark="60 days")
    messages = to_messages(raw_events(spark, sf_dir)).withColumn(
        "part", F.pmod(F.crc32(F.get_json_object("value", "$.event_id")), F.lit(3)))
    for part in range(3):
        (messages.filter(F.col("part") == part).select("key", "value")
                 .write.mode("append").parquet(f"{root}/messages"))
        stream = spark.readStream.schema("key string, value string").parquet(f"{root}/messages")
        jobs.finish([jobs.start_serving(decode_messages(stream), [TRENDING_PRODUCTS], root, settings, available_now=True,
                                        tops={"trending_products": ("revenue", 5)})])
    return toplist.read_list(spark, f"{root}/serving", TRENDING_PRODUCTS, "revenue")


def _near_exact(exact: DataFrame, estimated: DataFrame) -> DataFrame:
    """Exact users per window and product, and whether the estimate lies within four
    deviations of a sketch (and one user)."""
    keys = ["window_start", *TRENDING_PRODUCTS.keys]
    other = estimated.select(*[F.col(k).alias(f"their_{k}") for k in keys], F.col("unique_users").alias("estimate"))
    both = exact.select(*keys, "unique_users").join(
        other, [F.col(k).eqNullSafe(F.col(f"their_{k}")) for k in keys], "full")
    apart = F.abs(F.col("estimate") - F.col("unique_users"))
    within = apart <= 1 + F.col("unique_users") * (4 * 1.04 / 2 ** (SKETCH / 2))
    return both.select("window_start", "product_id", "unique_users", F.coalesce(within, F.lit(False)).alias("within"))


@query
def approximate_users(spark, sf_dir):
    events = shop_events(spark, sf_dir)
    return _near_exact(window_table(events, TRENDING_PRODUCTS, WEEKLY),
                       window_table(events, TRENDING_PRODUCTS.with_approximate_users(), WEEKLY))


@query
def approximate_users_stream(spark, sf_dir):
    """Sketches per key and pane, kept by the stream and merged on read."""
    root, settings = fresh_root(spark), Settings(window=WEEKLY.window, slide=WEEKLY.slide, approximate_users=True)
    jobs.finish([jobs.start_serving(event_stream(spark, sf_dir), [TRENDING_PRODUCTS], root, settings, available_now=True)])
    exact = window_table(shop_events(spark, sf_dir).withColumn(
        "event_timestamp", F.col("event_timestamp").cast("timestamp")), TRENDING_PRODUCTS, WEEKLY)
    return _near_exact(exact, panes.read_latest(spark, f"{root}/serving", TRENDING_PRODUCTS, ttl=None))


@query
def all_tables_stream(spark, sf_dir):
    """Three tables from one pass over the source; the rows of each, added up."""
    root, settings = fresh_root(spark), Settings(window=WEEKLY.window, slide=WEEKLY.slide)
    jobs.finish([jobs.start_serving(event_stream(spark, sf_dir), list(TABLES.values()), root, settings,
                                    available_now=True)])
    parts = [panes.read_latest(spark, f"{root}/serving", table, ttl=None)
             .agg(F.count(F.lit(1)).alias("windows"), F.sum("total_events").alias("total_events"),
                  F.sum("revenue").alias("revenue")).select(F.lit(name).alias("name"), "*")
             for name, table in TABLES.items()]
    return parts[0].union(parts[1]).union(parts[2])


@query
def serving_keys_read(spark, sf_dir):
    """The rows of a list of windows and categories, read together from a stream's panes.

    Every third key is asked for, and one window that is not there.
    """
    root, settings = fresh_root(spark), Settings(window=WEEKLY.window, slide=WEEKLY.slide)
    jobs.finish([jobs.start_serving(event_stream(spark, sf_dir), [CATEGORY_ANALYTICS], root, settings, available_now=True)])
    days = shop_events(spark, sf_dir).select(F.date_trunc("day", "event_timestamp").cast("timestamp").alias("window_start"),
                                             "category")
    wanted = days.filter(F.dayofmonth("window_start") % 3 == 0).distinct()
    absent = wanted.limit(1).select(F.lit("1999-01-01").cast("timestamp").alias("window_start"), "category")
    return (panes.read_keys(spark, f"{root}/serving", CATEGORY_ANALYTICS, wanted.union(absent))
            .select(*CATEGORY_ANALYTICS.columns))


@query
def serving_values_read(spark, sf_dir):
    """Key and value rows of many keys, from files in order of keys with Bloom filters."""
    path = f"{fresh_root(spark)}/values"
    rows = window_table(shop_events(spark, sf_dir), TRENDING_PRODUCTS, WEEKLY)
    serving.export_values(rows, path, TRENDING_PRODUCTS)
    wanted = serving.as_key_values(rows.filter(F.dayofmonth("window_start") == 9), TRENDING_PRODUCTS)
    found = serving.get_values(spark, path, TRENDING_PRODUCTS, wanted)
    return found.select("serving_key", F.get_json_object("value", "$.total_events").cast("bigint").alias("total_events"))


@query
def late_events(spark, sf_dir):
    """Error events come after all others, two days of lateness allowed, weekly windows.

    The second delivery is a restart from the checkpoint of the first.
    """
    root = fresh_root(spark)
    settings = Settings(window="7 days", slide="1 day", watermark="2 days")
    messages = to_messages(raw_events(spark, sf_dir)).withColumn(
        "late", F.get_json_object("value", "$.event_type") == "error")
    for late in (False, True):
        (messages.filter(F.col("late") == late).select("key", "value")
                 .write.mode("append").parquet(f"{root}/messages"))
        stream = spark.readStream.schema("key string, value string").parquet(f"{root}/messages")
        jobs.finish([jobs.start_serving(decode_messages(stream), [USER_BEHAVIOR], root, settings, available_now=True)])
    rows = panes.read_latest(spark, f"{root}/serving", USER_BEHAVIOR, ttl=None)
    return rows.select(*USER_BEHAVIOR.columns)


# --- serving table -----------------------------------------------------------

@query
def serving_latest(spark, sf_dir):
    """A first state without error events, then its refinement with all events."""
    root, events = fresh_root(spark), shop_events(spark, sf_dir)
    first = events.filter(F.col("event_type") != "error")
    for batch, known in enumerate((first, events)):
        totals = window_totals(known, CATEGORY_ANALYTICS, WEEKLY)
        serving.write_batch(totals, batch, root, CATEGORY_ANALYTICS, "r1")
    return (serving.read_latest(spark, root, CATEGORY_ANALYTICS, ttl=None)
            .select(*CATEGORY_ANALYTICS.columns, "batch"))


@query
def serving_unexpired(spark, sf_dir):
    """Rows last written at their window's end; now is the end of the newest window."""
    root, events = fresh_root(spark), shop_events(spark, sf_dir)
    serving.write_batch(window_totals(events, USER_BEHAVIOR), 0, root, USER_BEHAVIOR, "r1",
                        written_at=F.col("window_end"))
    now = latest_window_table(events, USER_BEHAVIOR).agg(F.max("window_end")).scalar()
    return (serving.read_latest(spark, root, USER_BEHAVIOR, now=now, ttl="1 hour")
            .select(*USER_BEHAVIOR.columns))


@query
def serving_keys(spark, sf_dir):
    rows = window_table(shop_events(spark, sf_dir), TRENDING_PRODUCTS)
    values = serving.as_key_values(rows, TRENDING_PRODUCTS)
    fields = "window_start string, product_name string, total_events bigint, conversion_rate double"
    return values.select("serving_key", F.from_json("value", fields).alias("v")).select(
        "serving_key", F.col("v.window_start").alias("window_start_text"), "v.product_name", "v.total_events",
        "v.conversion_rate")


def _some_missing(events: DataFrame, *columns: str) -> DataFrame:
    """Every fifth event without its values in those columns."""
    fifth = F.col("event_id").cast("bigint") % 5 == 0
    return events.withColumns({c: F.when(~fifth, F.col(c)) for c in columns})


@query
def serving_keys_behavior(spark, sf_dir):
    events = _some_missing(shop_events(spark, sf_dir), "user_agent", "source")
    values = serving.as_key_values(window_table(events, USER_BEHAVIOR, WEEKLY), USER_BEHAVIOR)
    return values.select("serving_key", F.get_json_object("value", "$.total_events")
                         .cast("bigint").alias("total_events"))


@query
def serving_keys_category(spark, sf_dir):
    events = _some_missing(shop_events(spark, sf_dir), "category")
    values = serving.as_key_values(window_table(events, CATEGORY_ANALYTICS, WEEKLY), CATEGORY_ANALYTICS)
    return values.select("serving_key", F.get_json_object("value", "$.total_events")
                         .cast("bigint").alias("total_events"))


@query
def windows_without_bad_times(spark, sf_dir):
    """Messages with bad times decode to events without a time, which no window holds."""
    events = decode_messages(_messages_with_rubbish(spark, sf_dir))
    return window_table(events, CATEGORY_ANALYTICS, WEEKLY)


@query
def serving_clean_read(spark, sf_dir):
    """Values stored with a cut copy, a copy with a bad time and an empty value each."""
    path = f"{fresh_root(spark)}/values"
    rows = window_table(shop_events(spark, sf_dir), USER_BEHAVIOR, WEEKLY)
    cut = F.substring("value", F.lit(1), (F.length("value") / 2).cast("int"))
    bad_time = F.regexp_replace("value", r'"window_start":"[^"]*"', '"window_start":"soon"')
    values = serving.as_key_values(rows, USER_BEHAVIOR).withColumn(
        "value", F.explode(F.array("value", cut, bad_time, F.lit(""))))
    values.write.parquet(f"{path}/prefix={USER_BEHAVIOR.name}")
    return serving.decode_values(serving.read_values(spark, path, USER_BEHAVIOR), USER_BEHAVIOR)


# --- reports on the latest window --------------------------------------------

def _latest(spark: SparkSession, sf_dir: str, table: WindowTable) -> DataFrame:
    return latest_window_table(shop_events(spark, sf_dir), table, WEEKLY)


@query
def latest_window_products(spark, sf_dir):
    return at_latest_window(_latest(spark, sf_dir, TRENDING_PRODUCTS),
                            of=_latest(spark, sf_dir, USER_BEHAVIOR))


@query
def kpi_snapshot(spark, sf_dir):
    return reports.kpi_snapshot(_latest(spark, sf_dir, TRENDING_PRODUCTS),
                                _latest(spark, sf_dir, USER_BEHAVIOR))


@query
def kpi_snapshot_lagging(spark, sf_dir):
    """Products stop a day before behavior does, so the common newest window has none of them."""
    events = shop_events(spark, sf_dir)
    newest_day = events.agg(F.date_trunc("day", F.max("event_timestamp"))).scalar()
    products = window_table(events.filter(F.col("event_timestamp") < newest_day), TRENDING_PRODUCTS, WEEKLY)
    behavior = window_table(events, USER_BEHAVIOR, WEEKLY)
    return reports.kpi_snapshot(products, behavior)


@query
def latest_complete_window(spark, sf_dir):
    """The newest window that had ended when the newest of all opened."""
    return at_latest_window(window_table(shop_events(spark, sf_dir), CATEGORY_ANALYTICS, WEEKLY),
                            complete_only=True)


@query
def overview_headlines(spark, sf_dir):
    return reports.overview(_latest(spark, sf_dir, TRENDING_PRODUCTS),
                            _latest(spark, sf_dir, USER_BEHAVIOR))


@query
def top_channel(spark, sf_dir):
    return reports.top_row_value(_latest(spark, sf_dir, USER_BEHAVIOR), "source",
                                 ties=("user_agent", "source"), alias="top_channel")


@query
def top_category(spark, sf_dir):
    return reports.top_row_value(_latest(spark, sf_dir, TRENDING_PRODUCTS), "category",
                                 ties=("product_id", "product_name", "category"),
                                 alias="top_category")


@query
def performer_insight(spark, sf_dir):
    best = reports.top_k(_latest(spark, sf_dir, TRENDING_PRODUCTS), "revenue")
    return reports.performer_insight(best, "revenue", "product_name")


@query
def performer_insight_low(spark, sf_dir):
    categories = _latest(spark, sf_dir, CATEGORY_ANALYTICS)
    return reports.performer_insight(categories, "total_events", "category", high_is_good=False)


def _top10(metric: str) -> None:
    def build(spark, sf_dir):
        return reports.top_k(_latest(spark, sf_dir, TRENDING_PRODUCTS), metric).select(
            "window_start", "product_id", "product_name", "category", metric)

    build.__name__ = f"top10_{metric}"
    query(build)


for _metric in ("revenue", "purchases", "total_events"):
    _top10(_metric)


@query
def top3_per_category(spark, sf_dir):
    return reports.top_k(_latest(spark, sf_dir, TRENDING_PRODUCTS), "revenue", 3,
                         per=("category",)).select("category", "place", "product_id", "revenue")


@query
def revenue_rollup(spark, sf_dir):
    return reports.revenue_rollup(_latest(spark, sf_dir, TRENDING_PRODUCTS))


@query
def category_conversion_rank(spark, sf_dir):
    return reports.conversion_rank(_latest(spark, sf_dir, CATEGORY_ANALYTICS))


@query
def channel_funnel(spark, sf_dir):
    funnel = reports.channel_funnel(_latest(spark, sf_dir, USER_BEHAVIOR))
    return funnel.withColumn("conversion_rate", F.round("conversion_rate", 4))


@query
def channel_labels(spark, sf_dir):
    return reports.metric_labels(_latest(spark, sf_dir, USER_BEHAVIOR), "source")


# --- reports over all windows ------------------------------------------------

@query
def category_share(spark, sf_dir):
    return reports.revenue_share(window_table(shop_events(spark, sf_dir), CATEGORY_ANALYTICS,
                                              WEEKLY))


@query
def product_names(spark, sf_dir):
    return reports.product_names(window_table(shop_events(spark, sf_dir), TRENDING_PRODUCTS,
                                              HOURLY))


@query
def product_compare(spark, sf_dir):
    events = shop_events(spark, sf_dir)
    first, second = reports.first_two_names(events)
    both = events.filter((F.col("product_name") == first) | (F.col("product_name") == second))
    products = window_table(both, TRENDING_PRODUCTS.without_users(), WEEKLY)
    return reports.compare_products(products, first, second)


@query
def channel_revenue_pivot(spark, sf_dir):
    return reports.channel_revenue_pivot(window_table(shop_events(spark, sf_dir), USER_BEHAVIOR,
                                                      HOURLY), SOURCES).select(
        "window_start", *[F.round(s, 2).alias(s) for s in SOURCES])


@query
def channel_revenue_long(spark, sf_dir):
    return reports.channel_revenue(window_table(shop_events(spark, sf_dir), USER_BEHAVIOR, HOURLY))


# --- time series -------------------------------------------------------------

def _hourly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.revenue_per_window(window_table(shop_events(spark, sf_dir), TRENDING_PRODUCTS,
                                                   HOURLY))


def _hourly_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = window_table(shop_events(spark, sf_dir), CATEGORY_ANALYTICS, HOURLY)
    return rows.select("category", "window_start", "revenue")


@query
def revenue_trend(spark, sf_dir):
    return reports.revenue_trend(window_table(shop_events(spark, sf_dir), TRENDING_PRODUCTS, HOURLY))


@query
def revenue_densified(spark, sf_dir):
    return series.densify(_hourly_by_category(spark, sf_dir), "1 hour", ["category"])


@query
def revenue_bands(spark, sf_dir):
    return series.rolling_bands(_hourly_revenue(spark, sf_dir))


@query
def category_bands(spark, sf_dir):
    return series.rolling_bands(_hourly_by_category(spark, sf_dir), series=["category"])


@query
def revenue_anomalies(spark, sf_dir):
    return series.anomalies(series.rolling_bands(_hourly_revenue(spark, sf_dir)))


@query
def latest_anomaly(spark, sf_dir):
    return series.latest_anomaly(series.rolling_bands(_hourly_revenue(spark, sf_dir)))


@query
def revenue_forecast(spark, sf_dir):
    dense = series.densify(_hourly_revenue(spark, sf_dir), "1 hour")
    return forecast(dense, step="1 hour")


@query
def category_forecast(spark, sf_dir):
    dense = series.densify(_hourly_by_category(spark, sf_dir), "1 hour", ["category"])
    return forecast(dense, step="1 hour", series=["category"])


@query
def forecast_total(spark, sf_dir):
    dense = series.densify(_hourly_revenue(spark, sf_dir), "1 hour")
    return forecast_summary(forecast(dense, step="1 hour"), step="1 hour")


@query
def forecast_history(spark, sf_dir):
    """Series by the hour have a forecast; by the week they are too short for one."""
    weeks = window_table(shop_events(spark, sf_dir), CATEGORY_ANALYTICS, Grain("7 days", None))
    hours = series.densify(_hourly_by_category(spark, sf_dir), "1 hour", ["category"])
    return (history(hours, ["category"]).withColumn("step", F.lit("hour"))
            .union(history(weeks, ["category"]).withColumn("step", F.lit("week"))))
