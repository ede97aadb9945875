from pyspark.sql import functions as F

from helpers import at, event, events, tuples
from tidegauge.functions.text import clock, grouped, iso_time, key_time, label, title_case, whole_grouped
from tidegauge.operators import reports
from tidegauge.operators.windowed import category_analytics, trending_products, user_behavior


def products(spark, rows):
    """(minute, product, name, category, revenue, purchases, clicks)"""
    return spark.createDataFrame(
        [(at(m), at(m + 10), p, n, c, r, b, k, (b or 0) + (k or 0)) for m, p, n, c, r, b, k in rows],
        "window_start timestamp, window_end timestamp, product_id string, product_name string, "
        "category string, revenue double, purchases bigint, clicks bigint, total_events bigint")


def behavior(spark, rows):
    """(minute, device, source, revenue, purchases, clicks)"""
    return spark.createDataFrame(
        [(at(m), d, s, r, b, k) for m, d, s, r, b, k in rows],
        "window_start timestamp, user_agent string, source string, revenue double, "
        "purchases bigint, clicks bigint")


def test_text_functions(spark):
    row = spark.createDataFrame([("paid_search", 1234567.891, at(61.5), "o'NEIL a1b")],
                                "a string, x double, t timestamp, b string")
    got = row.select(title_case(F.col("a")), label(F.col("a")), title_case(F.col("b")),
                     grouped(F.col("x")), whole_grouped(F.col("x")), clock(F.col("t")),
                     iso_time(F.col("t")), key_time(F.col("t")),
                     key_time(F.lit(None).cast("timestamp"))).collect()[0]
    assert tuple(got) == ("Paid_Search", "Paid Search", "o'NEIL a1b".title(), "1,234,567.89", "1,234,567",
                          "01:01:30", "2024-01-01T01:01:30.000000", "2024-01-01T01_01_30_000Z", "")


def test_snapshot_of_the_behavior_window(spark):
    items = products(spark, [(0, "a", "A", "x", 5.0, 1, 2), (1, "a", "A", "x", 60.0, 3, 4),
                             (1, "b", "B", "y", 40.0, 1, 0), (1, "c", "C", "y", 40.0, 0, 0)])
    channels = behavior(spark, [(1, "mobile", "email", 60.0, 1, 1), (1, "mobile", "social", 40.0, 1, 1),
                                (1, "tablet", "social", 40.0, 1, 1), (0, "tablet", "direct", 99.0, 1, 1)])
    assert tuples(reports.kpi_snapshot(items, channels), "total_revenue", "total_purchases",
                  "total_clicks", "overall_conversion_rate") == [(140.0, 4, 4, 100.0)]
    row = reports.overview(items, channels).collect()[0]
    # one row decides, not the sum per channel or category
    assert (row["top_channel"], row["top_category"]) == ("email", "x")
    assert row["title"] == "Live Snapshot (Window starting at 00:01:00)"
    assert (row["revenue_text"], row["purchases_text"], row["conversion_text"]) == ("€140.00", "4", "100.00%")
    assert row["channel_text"] == "The **Email** channel is currently driving the most revenue."
    assert row["category_text"] == "**X** is the highest-earning product category right now."


def test_snapshot_when_products_lag(spark):
    items = products(spark, [(0, "a", "A", "x", 5.0, 1, 2)])
    channels = behavior(spark, [(1, "mobile", "email", 60.0, 1, 1)])
    row = reports.overview(items, channels).collect()[0]
    assert (row["total_revenue"], row["total_purchases"], row["overall_conversion_rate"]) == (0.0, 0, 0.0)
    assert (row["top_channel"], row["top_category"]) == ("email", "N/A")


def test_top_row_value(spark):
    rows = behavior(spark, [(1, "m", "b", 7.0, 0, 0), (1, "d", "c", 7.0, 0, 0), (1, "a", "z", None, 0, 0)])
    assert tuples(reports.top_row_value(rows, "source"), "source") == [("b",)]
    assert tuples(reports.top_row_value(rows, "source", ties=("user_agent",)), "source") == [("c",)]
    assert tuples(reports.top_row_value(rows.limit(0), "source", alias="top"), "top") == [("N/A",)]


def test_insight(spark):
    rows = products(spark, [(0, "a", "A", "x", 1234.5, 1, 2), (0, "b", "B", "x", 2.0, 9, 9),
                            (0, "c", "C", "x", None, 5, 9), (0, "d", "D", "x", 2.0, 9, 9)])
    high = reports.performer_insight(rows, "revenue", "product_name").collect()[0]
    assert tuple(high) == ("A", 1234.5, "B", 2.0,
                           "**Top Performer:** `A` is leading with **1,234.50** in revenue.")
    low = reports.performer_insight(rows, "total_events", "product_name", high_is_good=False).collect()[0]
    assert tuple(low)[:4] == ("A", 3.0, "B", 18.0)
    assert low["insight"] == ("**Top Performer:** `A` is performing best with the lowest "
                              "total_events of **3.00**.")
    spaced = reports.performer_insight(rows, "total_events", "product_name").collect()[0]
    assert spaced["insight"].endswith("in total events.")
    none = reports.performer_insight(rows.limit(0), "revenue", "product_name").collect()[0]
    assert tuple(none) == (None, None, None, None, "Not enough data for an insight.")


def test_top_k(spark):
    rows = products(spark, [(0, f"p{i:02d}", "N", "xy"[i % 2], float(i // 2), i, 0) for i in range(24)]
                    + [(0, "none", "N", "x", None, None, 0)])
    top = [r["product_id"] for r in reports.top_k(rows, "revenue").collect()]
    assert top == ["p22", "p23", "p20", "p21", "p18", "p19", "p16", "p17", "p14", "p15"]
    assert len(reports.top_k(rows, "purchases", 100).collect()) == 24
    per = reports.top_k(rows, "revenue", 1, per=("category",))
    assert tuples(per, "category", "place", "product_id") == [("x", 1, "p22"), ("y", 1, "p23")]
    assert "TakeOrderedAndProject" in reports.top_k(rows, "revenue")._jdf.queryExecution().toString()


def test_compare(spark):
    rows = products(spark, [(1, "a", "A", "x", 0.0, 5, 0), (2, "a", "A", "x", 0.0, 6, 0),
                            (2, "b", "B", "x", 0.0, 7, 0), (3, "b", "B", "x", 0.0, 8, 0)])
    got = reports.compare_products(rows, "A", "B").collect()
    assert [tuple(r) for r in got] == [(at(1), 5, 0), (at(2), 6, 7), (at(3), 0, 8)]
    assert [tuple(r) for r in reports.compare_products(rows, *reports.first_two_names(rows)).collect()] \
        == [tuple(r) for r in got]
    same = reports.compare_products(rows, "A", "A").collect()
    assert [tuple(r) for r in same] == [(at(1), 5, 5), (at(2), 6, 6)]
    one = rows.filter("product_name = 'A'")
    assert reports.compare_products(one, *reports.first_two_names(one)).count() == 2


def test_compare_adds_up_the_ids_of_a_shared_name(spark):
    rows = products(spark, [(1, "a", "A", "x", 0.0, 5, 0), (1, "a2", "A", "x", 0.0, 6, 0),
                            (1, "b", "B", "x", 0.0, 7, 0), (1, "b2", "B", "x", 0.0, 8, 0), (1, "c", "C", "x", 0.0, 9, 0)])
    compared = reports.compare_products(rows, "A", "B")
    assert tuples(compared, "product_1", "product_2") == [(11, 15)]
    assert "Join" not in compared._jdf.queryExecution().toString()


def test_rollup_and_share(spark):
    rows = products(spark, [(0, "a", "A", "x", 1.0, 0, 0), (0, "a2", "A", "x", 2.0, 0, 0),
                            (0, "b", "B", "x", 3.0, 0, 0), (0, "c", "C", None, 4.0, 0, 0)])
    got = {tuple(r) for r in reports.revenue_rollup(rows).collect()}
    assert got == {(0, None, None, 10.0), (1, "x", None, 6.0), (1, None, None, 4.0),
                   (2, "x", "A", 3.0), (2, "x", "B", 3.0), (2, None, "C", 4.0)}
    share = reports.revenue_share(rows).collect()
    assert {(r["category"], r["share"]) for r in share} == {("x", 0.6), (None, 0.4)}
    none = reports.revenue_share(products(spark, [(0, "a", "A", "x", 0.0, 0, 0)])).collect()
    assert [r["share"] for r in none] == [None]


def test_funnel_and_channels(spark):
    rows = behavior(spark, [(0, "m", "email", 1.0, 3, 0), (0, "d", "email", 2.0, 0, 0),
                            (0, "m", "social", 5.0, 1, 4), (1, "m", "email", 7.0, 0, 1),
                            (0, "m", None, 9.0, 1, 1)])
    first = rows.filter(F.col("window_start") == F.lit(at(0)))
    assert tuples(reports.channel_funnel(first), "source", "clicks", "purchases", "conversion_rate") == [
        ("email", 0, 3, 300.0), ("social", 4, 1, 25.0)]
    pivot = reports.channel_revenue_pivot(rows, ["email", "social", "direct"]).collect()
    assert [tuple(r) for r in pivot] == [(at(0), 3.0, 5.0, 0.0), (at(1), 7.0, 0.0, 0.0)]
    assert tuples(reports.channel_revenue(rows), "window_start", "source", "revenue") == [
        (at(0), "email", 3.0), (at(0), "social", 5.0), (at(1), "email", 7.0)]


def test_trend_names_and_rank(spark):
    rows = events(spark, [event(0, "purchase", revenue=2.0, name="Zed"), event(0, "click", name="Ada"),
                          event(5, "purchase", revenue=1.0, name="Ada", category="other")])
    trend = reports.revenue_trend(trending_products(rows)).collect()
    assert [r["window_start"] for r in trend] == [at(m) for m in range(-9, 6)]
    assert [r["revenue"] for r in trend][:6] == [2.0] * 5 + [3.0]
    assert [r[0] for r in reports.product_names(trending_products(rows)).collect()] == ["Ada", "Zed"]
    ranked = reports.conversion_rank(category_analytics(rows)).collect()
    rates = [r["conversion_rate"] for r in ranked]
    assert rates == sorted(rates, reverse=True)
    labels = reports.metric_labels(user_behavior(rows), "source").collect()
    assert [tuple(r) for r in labels] == [("organic", "Organic", "Organic")]
