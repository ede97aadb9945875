import math
import random

import pandas as pd
import pytest
from hypothesis import given, settings as hypothesis_settings, strategies as st
from pyspark.sql import functions as F

from helpers import at, tuples
from tidegauge.operators import series
from tidegauge.operators.forecast import GRID, fit, forecast, forecast_summary


def points(spark, values, minutes=None, name=None):
    minutes = range(len(values)) if minutes is None else minutes
    rows = [(name, at(m), v) for m, v in zip(minutes, values)]
    return spark.createDataFrame(rows, "name string, window_start timestamp, revenue double")


def test_densify(spark):
    got = series.densify(points(spark, [1.0, 2.0], [0, 3])).orderBy("window_start").collect()
    assert [tuple(r) for r in got] == [(at(0), 1.0), (at(1), 0.0), (at(2), 0.0), (at(3), 2.0)]


def test_densify_per_series_and_off_the_grid(spark):
    rows = points(spark, [1.0, 2.0, 9.0, None], [0, 2, 2.5, 3], "a").union(
        points(spark, [5.0], [7], "b")).union(points(spark, [6.0, 7.0], [0.5, 1.5], "c"))
    got = tuples(series.densify(rows, "1 minute", ["name"]), "name", "window_start", "revenue")
    assert got == [("a", at(0), 1.0), ("a", at(1), 0.0), ("a", at(2), 2.0), ("a", at(3), 0.0),
                   ("b", at(7), 5.0), ("c", at(0.5), 6.0), ("c", at(1.5), 7.0)]


@hypothesis_settings(max_examples=8, deadline=None)
@given(st.sets(st.integers(0, 200), min_size=1, max_size=30))
def test_densify_has_no_gap_and_keeps_the_total(spark, minutes):
    minutes = sorted(minutes)
    rows = points(spark, [float(m) for m in minutes], minutes)
    got = series.densify(rows).orderBy("window_start").collect()
    assert [r["window_start"] for r in got] == [at(m) for m in range(minutes[0], minutes[-1] + 1)]
    assert sum(r["revenue"] for r in got) == sum(minutes)


def test_bands(spark):
    rows = series.rolling_bands(points(spark, [10.0, 12.0, 8.0, 50.0, 9.0]), 3, 1.0).orderBy("window_start")
    got = rows.collect()
    assert [r["rolling_mean"] and round(r["rolling_mean"], 3) for r in got] == [None, None, 10.0, 23.333, 22.333]
    assert [r["rolling_std"] and round(r["rolling_std"], 3) for r in got] == [None, None, 2.0, 23.180, 23.965]
    assert [r["anomaly"] for r in got] == [False, False, False, True, False]
    assert tuples(series.anomalies(rows), "window_start", "anomalous_revenue") == [(at(3), 50.0)]
    last = series.latest_anomaly(rows).collect()
    assert [r["alert"] for r in last] == [
        "**Latest Anomaly Alert:** Revenue of **€50.00** was detected at **00:03:00**, "
        "which is outside the expected range."]


@hypothesis_settings(max_examples=6, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(0, 50)), min_size=6, max_size=60), st.integers(2, 9), st.booleans())
def test_bands_across_block_borders_equal_pandas(spark, values, size, before):
    minutes = [m + (m // 9) * 25 for m in range(len(values))]  # some blocks without a point
    rows = points(spark, [None if v is None else float(v) for v in values], minutes)
    got = series.rolling_bands(rows, size, exclude_current=before, block="10 minutes").orderBy("window_start").collect()
    assert [r["window_start"] for r in got] == [at(m) for m in minutes]
    for column, want in (("rolling_mean", "mean"), ("rolling_std", "std")):
        rolling = pd.Series(values, dtype=float).shift(1 if before else 0).rolling(size)
        for r, x in zip(got, getattr(rolling, want)()):
            assert (r[column] is None) == math.isnan(x)
            assert r[column] is None or abs(r[column] - x) < 1e-6


def test_densify_in_blocks(spark):
    minutes = [0, 3, 19, 20, 57, 58]
    got = series.densify(points(spark, [1.0] * 6, minutes), block="7 minutes").orderBy("window_start").collect()
    assert [(r["window_start"], r["revenue"]) for r in got] == [(at(m), float(m in minutes)) for m in range(59)]


@pytest.mark.parametrize("keys", [[], ["name"]], ids=["global", "keyed"])
def test_no_task_holds_a_series_and_the_input_is_read_once(spark, shared, keys):
    """Windows go over blocks (one small row each) or lie within a block."""
    points(spark, [1.0] * 40, name="a").write.parquet(f"{shared}/points")
    rows = series.rolling_bands(series.densify(spark.read.parquet(f"{shared}/points"), series=keys), series=keys)
    assert len(rows.collect()) == 40
    text = rows._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in text.splitlines() if "+- Window" in line or ":- Window" in line]
    assert windows and not any("revenue" in line and "__block" not in line for line in windows)
    final = text[: text.index("== Initial Plan ==")] if "== Initial Plan ==" in text else text
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_long_keyed_series_in_blocks_equal_pandas(spark):
    rng = random.Random(3)
    frames = {name: [float(rng.randrange(50)) for _ in range(n)] for name, n in (("a", 70), ("b", 9), (None, 33))}
    rows = None
    for name, values in frames.items():
        some = points(spark, values, [m * 2 for m in range(len(values))], name)
        rows = some if rows is None else rows.union(some)
    got = series.rolling_bands(rows, 4, series=["name"], block="15 minutes").collect()
    dense = series.densify(rows, "1 minute", ["name"], block="15 minutes")
    for name, values in frames.items():
        own = sorted((r for r in got if r["name"] == name), key=lambda r: r["window_start"])
        assert [r["revenue"] for r in own] == values
        for r, x in zip(own, pd.Series(values).rolling(4).mean()):
            assert (r["rolling_mean"] is None and math.isnan(x)) or r["rolling_mean"] == pytest.approx(x)
        filled = dense.filter(F.col("name").eqNullSafe(F.lit(name))).orderBy("window_start").collect()
        assert [r["window_start"] for r in filled] == [at(m) for m in range(2 * len(values) - 1)]
        assert [r["revenue"] for r in filled] == [values[m // 2] if m % 2 == 0 else 0.0 for m in range(2 * len(values) - 1)]


def test_too_little_history(spark):
    few = points(spark, [1.0, 2.0, 3.0, 400.0])
    assert series.rolling_bands(few, 2, 0.1).isEmpty()
    assert series.latest_anomaly(series.rolling_bands(few, 2, 0.1)).isEmpty()
    both = points(spark, [1.0] * 4, name="short").union(points(spark, [1.0] * 5, name="long"))
    kept = series.rolling_bands(both, 2, series=["name"])
    assert {r["name"] for r in kept.collect()} == {"long"}


def test_the_current_value_may_be_excluded(spark):
    steady = [10.0, 11.0] * 5 + [100.0]
    inside = series.rolling_bands(points(spark, steady), 10, 3.0)
    outside = series.rolling_bands(points(spark, steady), 10, 3.0, exclude_current=True)
    assert series.anomalies(inside).isEmpty()
    assert tuples(series.anomalies(outside), "window_start") == [(at(10),)]


@hypothesis_settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=5, max_size=40), st.integers(2, 12))
def test_bands_equal_pandas(spark, values, size):
    got = series.rolling_bands(points(spark, [float(v) for v in values]), size).orderBy("window_start").toPandas()
    rolling = pd.Series(values, dtype=float).rolling(size)
    for column, expect in (("rolling_mean", rolling.mean()), ("rolling_std", rolling.std())):
        for a, b in zip(got[column], expect):
            assert (pd.isna(a) and pd.isna(b)) or math.isclose(a, b, abs_tol=1e-6)


def holt_winters(y, m, alpha, beta, gamma):
    first, second = sum(y[:m]) / m, sum(y[m:2 * m]) / m
    level, trend, sse = first, (second - first) / m, 0.0
    season = {i - m: y[i] - first for i in range(m)}
    for t, v in enumerate(y):
        due = season[t - m]
        sse += (v - (level + trend + due)) ** 2
        before = level
        level = alpha * (v - due) + (1 - alpha) * (before + trend)
        season[t] = gamma * (v - before - trend) + (1 - gamma) * due
        trend = beta * (level - before) + (1 - beta) * trend
    return level, trend, [season[len(y) - m + i] for i in range(m)], sse


Y = [10.0, 20.0, 30.0, 12.0, 22.0, 33.0, 14.0, 25.0, 35.0]


def test_fit_equals_the_recurrences(spark):
    weights = (0.3, 0.6, 0.1)
    level, trend, season, sse = holt_winters(Y, 3, *weights)
    row = fit(points(spark, Y), period=3, grid=[weights]).collect()[0]
    assert row["last"] == at(8)
    assert row["state"]["level"] == pytest.approx(level, abs=1e-12)
    assert row["state"]["trend"] == pytest.approx(trend, abs=1e-12)
    assert row["state"]["season"] == pytest.approx(season, abs=1e-12)
    assert row["state"]["sse"] == pytest.approx(sse, abs=1e-9)


def test_grid_choice_has_the_least_error(spark):
    row = fit(points(spark, Y), period=3).collect()[0]
    best = min(GRID, key=lambda g: (holt_winters(Y, 3, *g)[3], g))
    assert tuple(row["state"][w] for w in ("alpha", "beta", "gamma")) == best


def test_series_of_different_length_in_one_batch(spark):
    series = {f"s{n}": [float((7 * i * n) % 13 + i) for i in range(n)] for n in (6, 31, 7, 18, 25)}
    frame = None
    for name, values in series.items():
        rows = points(spark, values, name=name)
        frame = rows if frame is None else frame.union(rows)
    got = {r["name"]: r["state"] for r in fit(frame.coalesce(1), ["name"], period=3).collect()}
    for name, values in series.items():
        best = min(GRID, key=lambda g: (holt_winters(values, 3, *g)[3], g))
        level, trend, season, sse = holt_winters(values, 3, *best)
        assert got[name]["level"] == pytest.approx(level, abs=1e-9)
        assert got[name]["trend"] == pytest.approx(trend, abs=1e-9)
        assert got[name]["season"] == pytest.approx(season, abs=1e-9)
        assert got[name]["sse"] == pytest.approx(sse, rel=1e-9)


def test_forecast(spark):
    weights = (0.3, 0.6, 0.1)
    level, trend, season, _ = holt_winters(Y, 3, *weights)
    got = forecast(points(spark, Y), horizon=7, period=3, grid=[weights]).orderBy("timestamp")
    rows = got.collect()
    assert [r["timestamp"] for r in rows] == [at(8 + h) for h in range(1, 8)]
    expect = [level + h * trend + season[(h - 1) % 3] for h in range(1, 8)]
    assert [r["predicted_revenue"] for r in rows] == pytest.approx(expect, abs=1e-9)
    total = forecast_summary(got, 7).collect()[0]
    assert total["total_revenue"] == pytest.approx(sum(expect))
    assert total["summary"] == ("**Forecast Summary:** The model predicts a total revenue of "
                                f"**€{sum(expect):,.2f}** over the next 7 minutes.")


def test_a_pure_season_is_continued(spark):
    y = [float(10 + i % 12) for i in range(48)]
    rows = forecast(points(spark, y), horizon=24).orderBy("timestamp").collect()
    assert [round(r["predicted_revenue"], 6) for r in rows] == [10 + i % 12 for i in range(24)]


def test_short_series_have_no_forecast(spark):
    long_one = points(spark, [float(i % 5) for i in range(24)], name="long")
    rows = long_one.union(points(spark, [1.0] * 23, name="short"))
    got = forecast(rows, horizon=2, series=["name"])
    assert tuples(got, "name") == [("long",)] * 2
    assert forecast(points(spark, [1.0] * 23)).isEmpty()
    assert forecast_summary(forecast(points(spark, [1.0] * 23))).isEmpty()


def test_series_are_independent(spark):
    a = [float(3 * i % 7) for i in range(30)]
    b = [float(5 * i % 11 + i) for i in range(40)]
    together = forecast(points(spark, a, name="a").union(points(spark, b, name="b")),
                        horizon=3, series=["name"])
    for name, values in (("a", a), ("b", b)):
        alone = forecast(points(spark, values), horizon=3)
        assert tuples(together.filter(F.col("name") == name), "timestamp", "predicted_revenue") == \
            tuples(alone, "timestamp", "predicted_revenue")


def test_series_of_any_lengths_are_fitted_in_groups(spark):
    """The same fits whether a batch is padded as a whole or series by series."""
    from tidegauge.operators.forecast import _fitter
    rows = [[math.sin(i / 3) + i * 0.01 * k for i in range(24 + 13 * k)] for k in (3, 0, 7, 1, 7)]
    values = pd.Series(rows)
    one, many = (_fitter(12, GRID, cells).func(values) for cells in (1 << 20, 60))
    assert len(one) == 5 and one[["alpha", "beta", "gamma"]].equals(many[["alpha", "beta", "gamma"]])
    for a, b in zip(one.itertuples(index=False), many.itertuples(index=False)):
        assert (a.level, a.trend, a.sse) == pytest.approx((b.level, b.trend, b.sse))
        assert a.season == pytest.approx(b.season)
    assert len(_fitter(12, GRID).func(pd.Series([], dtype=object))) == 0


@pytest.mark.parametrize("search", [0, 2])
def test_a_series_in_blocks_fits_as_in_one_piece(spark, search):
    rng = random.Random(7)
    one = [100 + 10 * math.sin(i / 2) + 0.3 * i + rng.random() * 20 for i in range(130)]
    two = [50 + rng.random() * 9 for _ in range(61)]
    rows = points(spark, one, name="a").union(points(spark, two, name=None)).union(points(spark, [1.0] * 11, name="short"))
    whole = {r["name"]: r for r in fit(rows, ["name"], period=6, search=search).collect()}
    cut = {r["name"]: r for r in fit(rows, ["name"], period=6, search=search, block="7 minutes").collect()}
    assert whole.keys() == cut.keys() == {"a", None}
    for name, a in whole.items():
        b = cut[name]
        assert a["last"] == b["last"]
        for part in ("alpha", "beta", "gamma", "level", "trend", "sse"):
            assert b["state"][part] == pytest.approx(a["state"][part], rel=1e-9, abs=1e-9)
        assert b["state"]["season"] == pytest.approx(a["state"]["season"], rel=1e-9, abs=1e-9)
    alone = fit(points(spark, one), period=6, search=search, block="20 minutes").first()["state"]
    assert alone["level"] == pytest.approx(whole["a"]["state"]["level"], rel=1e-9)


def test_a_long_series_is_composed_in_several_tasks(spark):
    rows = points(spark, [float(i % 9) for i in range(90)])
    model = fit(rows, period=4, block="10 minutes")
    text = model._jdf.queryExecution().executedPlan().toString()
    composed = text[text.index("compose("):]
    assert "hashpartitioning(__block" in composed  # blocks are dealt out before they are composed
    assert model.first()["state"]["sse"] == pytest.approx(holt_winters([float(i % 9) for i in range(90)], 4, *[
        model.first()["state"][w] for w in ("alpha", "beta", "gamma")])[3], rel=1e-6)


def test_the_search_is_near_a_fine_grid_and_never_above_the_coarse_one(spark):
    for seed in range(3):
        rng = random.Random(seed)
        y = [20 + 5 * math.sin(i) + rng.random() * 8 + 0.1 * i for i in range(40)]
        coarse, fine = (fit(points(spark, y), period=4, search=n).first()["state"] for n in (0, 5))
        assert fine["sse"] <= coarse["sse"]
        steps = [0.01, *[i / 20 for i in range(1, 20)], 0.99]
        best = min(holt_winters(y, 4, a, b, g)[3] for a in steps for b in steps for g in steps)
        assert fine["sse"] <= best * 1.05
        weights = [fine[w] for w in ("alpha", "beta", "gamma")]
        assert fine["sse"] == pytest.approx(holt_winters(y, 4, *weights)[3])
