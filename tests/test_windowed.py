import pytest
from hypothesis import given, settings as hypothesis_settings, strategies as st
from pyspark.sql import functions as F

from conftest import SF
from helpers import at, event, events, same_rows, tuples, zoneless
from tidegauge.operators import windowed as w
from tidegauge.operators.grain import Grain, seconds
from tidegauge.operators.latest import at_latest_window, latest_window_start, latest_window_table
from tidegauge.plans.adapter import shop_events
from tidegauge.schema import SERVED_SCHEMAS

ALL_TABLES = list(w.TABLES.values())
WEEK = Grain("7 days", "1 day")


def by_expansion(rows, table, grain):
    """Every event under each of its windows, users listed and made distinct."""
    measures = [m.of_events() for m in table.measures]
    if table.distinct:
        column, output = table.distinct
        measures.append(F.size(F.array_distinct(F.collect_list(column))).alias(output))
    grouped = rows.groupBy(grain.column(F.col("event_timestamp")), *table.keys).agg(*measures)
    return table.finish(grouped.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *table.keys, *table.measure_names))


@pytest.mark.parametrize("text, length", [("10 minutes", 600), ("1 minute", 60), ("7 days", 604800),
                                          ("1 hour 30 minutes", 5400), ("2 weeks", 1209600)])
def test_interval_lengths(text, length):
    assert seconds(text) == length


@pytest.mark.parametrize("text", ["", "soon", "1 month", "minutes 10"])
def test_intervals_without_fixed_length(text):
    with pytest.raises(ValueError):
        seconds(text)


@pytest.mark.parametrize("table", ALL_TABLES, ids=lambda t: t.name)
@pytest.mark.parametrize("grain", [w.REALTIME, WEEK, Grain("1 hour", None), Grain("10 minutes", "4 minutes")],
                         ids=str)
def test_pane_path_equals_expansion(spark, table, grain):
    rows = shop_events(spark, SF)
    same_rows(w.window_table(rows, table, grain), by_expansion(rows, table, grain))


@hypothesis_settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.floats(-30, 45), st.sampled_from(["click", "purchase", "view"]),
                          st.sampled_from(["u1", "u2", "u3", None]),
                          st.sampled_from(["p1", "p2", None]), st.integers(0, 500)),
                min_size=1, max_size=60))
def test_pane_path_equals_expansion_on_dense_events(spark, rows):
    rows = events(spark, [event(round(m, 3), kind, user, product, revenue=cents / 100)
                          for m, kind, user, product, cents in rows])
    for frame in (rows, zoneless(rows)):
        got = same_rows(w.window_table(frame, w.TRENDING_PRODUCTS),
                        by_expansion(frame, w.TRENDING_PRODUCTS, w.REALTIME))
        names = [c for c in w.TRENDING_PRODUCTS.columns if c != "processed_at"]
        total = sum(r[names.index("total_events")] for r in got)
        assert total == 10 * rows.count()


def test_schemas(spark):
    rows = events(spark, [event(0)])
    for table in ALL_TABLES:
        got = w.window_table(rows, table).schema
        assert [(f.name, f.dataType) for f in got] == [
            (f.name, f.dataType) for f in SERVED_SCHEMAS[table.name]]


def test_window_edges_and_null_times(spark):
    rows = events(spark, [event(10), event(None)])
    starts = tuples(w.user_behavior(rows), "window_start")
    assert starts == [(at(m),) for m in range(1, 11)]


def test_purchases_without_clicks_convert_at_zero(spark):
    rows = events(spark, [event(0, "purchase", revenue=3.0), event(0, "purchase", revenue=4.01)])
    got = set(tuples(w.trending_products(rows), "purchases", "conversion_rate", "avg_revenue_per_event"))
    assert got == {(2, 0.0, 3.51)}


def test_rate_may_pass_one_hundred(spark):
    rows = events(spark, [event(0, "click")] + [event(0, "purchase", revenue=1.0)] * 3)
    assert set(tuples(w.user_behavior(rows), "conversion_rate")) == {(300.0,)}


def test_null_users_count_as_none(spark):
    rows = events(spark, [event(0, user=None), event(3, user=None), event(4, "view", product="p2")])
    assert set(tuples(w.trending_products(rows), "product_id", "unique_users")) == {("p1", 0), ("p2", 1)}


def test_null_keys_form_a_group(spark):
    rows = events(spark, [event(0, category=None), event(0)])
    assert {r[0] for r in w.category_analytics(rows).select("category").collect()} == {None, "cat"}


def test_quantity_counts_every_event(spark):
    rows = events(spark, [event(0, "click", quantity=1), event(0, "purchase", quantity=3, revenue=1.0),
                          event(0, "view", quantity=None)])
    assert set(tuples(w.category_analytics(rows), "total_quantity_sold")) == {(4,)}


def test_prices_are_per_event_and_skip_nulls(spark):
    rows = events(spark, [event(0, price=1.0), event(0, price=1.01), event(0, price=None)])
    assert set(tuples(w.category_analytics(rows), "avg_product_price", "max_product_price_in_category")) \
        == {(1.01, 1.01)}
    bare = events(spark, [event(0, price=None)])
    assert set(tuples(w.category_analytics(bare), "avg_product_price")) == {(None,)}


def test_a_returning_user_counts_once_per_window(spark):
    rows = events(spark, [event(m, user="u1") for m in (0, 3, 3.5, 9, 25)] + [event(3, user="u2")])
    got = {r["window_start"]: r["unique_users"] for r in w.trending_products(rows).collect()}
    for start, users in got.items():
        minutes = (start - at(0)).total_seconds() / 60
        expect = {"u1" for m in (0, 3, 3.5, 9, 25) if minutes <= m < minutes + 10}
        expect |= {"u2" for m in (3,) if minutes <= m < minutes + 10}
        assert users == len(expect)


def test_session_zone_does_not_move_zoneless_windows(spark):
    rows = events(spark, [event(130), event(131)])
    # the second event falls into an hour that New York's clocks skip
    rows = rows.withColumn("event_timestamp", F.to_timestamp_ntz(
        F.when(F.col("timestamp").contains("02:10"), "2024-01-01 02:10:00")
         .otherwise("2024-03-10 02:30:30")))

    def starts():
        table = w.user_behavior(rows)
        assert table.schema["window_start"].dataType.typeName() == "timestamp_ntz"
        return sorted(r[0] for r in table.select(F.col("window_start").cast("string")).collect())

    expect = starts()
    assert expect[0] == "2024-01-01 02:01:00" and expect[-1] == "2024-03-10 02:30:00"
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert starts() == expect
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_unknown_table():
    with pytest.raises(ValueError):
        w.table_named("clicks")


def test_latest_window(spark):
    rows = events(spark, [event(m, product=f"p{m}") for m in (0, 4, 12)])
    products = w.trending_products(rows)
    assert tuples(at_latest_window(products), "window_start", "product_id") == [(at(12), "p12")]
    complete = latest_window_start(products, complete_only=True).collect()[0][0]
    assert complete == at(2)
    behavior = w.user_behavior(events(spark, [event(4)]))
    assert tuples(at_latest_window(products, of=behavior), "product_id") == [("p12",), ("p4",)]


@pytest.mark.parametrize("table", ALL_TABLES, ids=lambda t: t.name)
@pytest.mark.parametrize("grain", [w.REALTIME, WEEK], ids=str)
def test_latest_window_from_events_equals_the_filtered_table(spark, table, grain):
    rows = shop_events(spark, SF)
    got = same_rows(latest_window_table(rows, table, grain),
                    at_latest_window(w.window_table(rows, table, grain)))
    assert got


def test_empty_input(spark):
    rows = events(spark, [event(None)])
    for table in ALL_TABLES:
        assert w.window_table(rows, table).isEmpty()
        assert latest_window_table(rows, table).isEmpty()
        assert at_latest_window(w.window_table(rows, table)).isEmpty()


def plan(frame):
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_plan_spreads_after_the_shuffle(spark):
    text = plan(w.trending_products(shop_events(spark, SF)))
    assert "Expand" not in text and "collect_set" not in text and "collect_list" not in text
    assert text.count("SinglePartition") == 0
    tree = text[:text.index("(1) Scan")]
    # the spreading Generate sits above the last Exchange, right under the final grouping
    assert tree.index("Generate") < tree.index("Exchange")


def test_latest_window_reads_only_the_tail(spark):
    text = plan(latest_window_table(shop_events(spark, SF), w.TRENDING_PRODUCTS, WEEK))
    assert "GreaterThanOrEqual(ts,ScalarSubquery" in text


def test_pane_rows_add_up(spark):
    rows = shop_events(spark, SF).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    for table in ALL_TABLES:
        some = [w.pane_rows(rows.filter(F.col("event_id").cast("long") % 3 == i), table, w.REALTIME) for i in range(3)]
        both = some[0].unionByName(some[1]).unionByName(some[2])
        same_rows(table.finish(w.totals_of_panes(both, table, w.REALTIME, rows.schema["event_timestamp"].dataType)),
                  w.window_table(rows, table))


def test_streams_are_refused_by_the_batch_path(spark):
    stream = spark.readStream.format("rate").load().withColumnRenamed("timestamp", "event_timestamp")
    with pytest.raises(ValueError):
        w.window_totals(stream, w.USER_BEHAVIOR)
