"""Additive Holt-Winters forecasts for any number of series at once, of any length.

    level   l = a (y - s[t-m]) + (1 - a) (l' + b')
    trend   b = c (l - l') + (1 - c) b'
    season  s = g (y - l' - b') + (1 - g) s[t-m]
    h steps ahead: l + h b + s[(h - 1) mod m]

The state starts from the first two seasons. Smoothing weights are those of a fixed grid
with the least one-step squared error, per series, and on request refined by a search
around the best grid point.

Series come in blocks of time (see ``series``). Those of one block, usually all, are
gathered by Spark and a pandas UDF walks through time once for all series of an Arrow
batch and all weights. In a longer series a step is, for given weights, an affine map of
the state, and its squared error a quadratic form of the state before it. Both are
composed per block, all blocks of a series side by side, and the few block results are
chained in order.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidegauge.functions.text import grouped
from tidegauge.operators.grain import seconds
from tidegauge.operators.series import BLOCK, in_blocks

# Season length, default horizon, wording.
PERIOD = 12
HORIZON = 30
SUMMARY = ("**Forecast Summary:** The model predicts a total revenue of **€%s** "
           "over the next %s.")
WEIGHTS = (0.1, 0.3, 0.6, 0.95)
GRID = tuple(product(WEIGHTS, WEIGHTS, WEIGHTS))
# Points, padding included, that a step of the fit holds at most beside one whole series.
CELLS = 1 << 20
# Bounds of the weights in a search, and its first step; each round halves it.
LEAST, MOST, FIRST_STEP = 0.01, 0.99, 0.16
# Steps whose errors are summed at once when a block is composed.
CHUNK = 256


STATE = ("struct<alpha: double, beta: double, gamma: double, level: double, trend: double, "
         "season: array<double>, sse: double>")
COMPOSED = "struct<map: array<double>, square: array<double>>"
MOVES = tuple(sorted(product((0, -1, 1), repeat=3), key=lambda move: sum(map(abs, move))))


def _around(best: np.ndarray, step: float) -> np.ndarray:
    """Weights a step from the best ones in any directions, themselves first: (..., 27, 3)."""
    return np.clip(best[..., None, :] + step * np.array(MOVES), LEAST, MOST)


def _fitter(period: int, grid: Sequence[tuple[float, float, float]], cells: int = CELLS, search: int = 0):
    """UDF from arrays of at least two seasons to the best weights and final state.

    All it needs is in its closure, so workers need numpy and pandas only.
    """
    grid = np.array([tuple(map(float, weights)) for weights in grid])
    columns = ["alpha", "beta", "gamma", "level", "trend", "season", "sse"]

    def fit_batch(series: pd.Series) -> pd.DataFrame:
        """Series of about the same length together, so that padding stays within ``cells``."""
        lengths = series.map(len).to_numpy()
        order, done, at = np.argsort(-lengths, kind="stable"), [], 0
        while at < len(order):
            stop = at + max(1, cells // max(1, int(lengths[order[at]])))
            some = series.iloc[order[at:stop]]
            best = fit_some(some, np.broadcast_to(grid, (len(some), *grid.shape)))
            for turn in range(search):
                tried = fit_some(some, _around(best[columns[:3]].to_numpy(float), FIRST_STEP / 2 ** turn))
                better = tried["sse"] < best["sse"]
                best = best.where(~better, tried)
            done.append(best)
            at = stop
        out = pd.concat(done, ignore_index=True) if done else pd.DataFrame([], columns=columns)
        return out.iloc[np.argsort(order)].reset_index(drop=True)

    def fit_some(series: pd.Series, weights: np.ndarray) -> pd.DataFrame:
        """The best of the weights of each series: (series, choices, 3)."""
        lengths = series.map(len).to_numpy()
        order = np.argsort(-lengths, kind="stable")  # longest first: the active ones lead
        alpha, beta, gamma = (weights[order, :, i] for i in range(3))
        values = np.zeros((lengths.max(initial=0), len(series)))
        for column, row in enumerate(order):
            values[:lengths[row], column] = series.iloc[row]
        active = [int(n) for n in (lengths[None, :] > np.arange(len(values))[:, None]).sum(axis=1)]

        first = values[:period].sum(axis=0) / period
        second = values[period:2 * period].sum(axis=0) / period
        shape = alpha.shape
        level = np.broadcast_to(first[:, None], shape).copy()
        trend = np.broadcast_to(((second - first) / period)[:, None], shape).copy()
        season = [np.broadcast_to((values[i] - first)[:, None], shape).copy()
                  for i in range(min(period, len(values)))]
        error = np.zeros(shape)
        for t, k in enumerate(active):
            y, due = values[t, :k, None], season[t % period][:k]
            before, slope = level[:k], trend[:k]
            ahead = before + slope
            miss = y - (ahead + due)
            error[:k] += miss * miss
            now = alpha[:k] * (y - due) + (1 - alpha[:k]) * ahead
            season[t % period][:k] = gamma[:k] * (y - before - slope) + (1 - gamma[:k]) * due
            trend[:k] = beta[:k] * (now - before) + (1 - beta[:k]) * slope
            level[:k] = now

        best = error.argmin(axis=1)
        fitted = {}
        for column, row in enumerate(order):
            g = best[column]
            due_next = [float(season[(lengths[row] + i) % period][column, g]) for i in range(period)]
            fitted[row] = (*map(float, weights[row, g]), level[column, g], trend[column, g], due_next, error[column, g])
        return pd.DataFrame([fitted[row] for row in range(len(series))], columns=columns)

    return F.pandas_udf(fit_batch, STATE)


def _composer(period: int):
    """UDF from the values of a block, the points before it and the weights to try (three
    each, end to end) to the block's map of the state and the squared error on it.

    The state is level, trend and the seasons by place modulo the period; the maps have a
    last column for the constant, and so have the quadratic forms.
    """

    def compose(values: pd.Series, before: pd.Series, weights: pd.Series) -> pd.DataFrame:
        found = [one(np.asarray(y, float), int(t), np.asarray(w, float).reshape(-1, 3))
                 for y, t, w in zip(values, before, weights)]
        return pd.DataFrame({"map": [m for m, _ in found], "square": [q for _, q in found]})

    def one(values: np.ndarray, before: int, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        alpha, beta, gamma = (weights[:, i, None] for i in range(3))
        n, size = len(weights), period + 2
        state = np.zeros((size, n, size + 1))
        state[np.arange(size), :, np.arange(size)] = 1.0
        square, misses = np.zeros((n, size + 1, size + 1)), np.empty((CHUNK, n, size + 1))
        for i, y in enumerate(values):
            due, level, trend = state[2 + (before + i) % period], state[0], state[1]
            ahead = level + trend
            miss = misses[i % CHUNK]
            np.add(ahead, due, out=miss)
            np.negative(miss, out=miss)
            miss[:, size] += y
            now = (1 - alpha) * ahead - alpha * due
            now[:, size] += alpha[:, 0] * y
            own = (1 - gamma) * due - gamma * ahead
            own[:, size] += gamma[:, 0] * y
            state[1] = beta * (now - level) + (1 - beta) * trend
            state[0], state[2 + (before + i) % period] = now, own
            if (i + 1) % CHUNK == 0 or i + 1 == len(values):
                some = misses[:i % CHUNK + 1].transpose(1, 0, 2)
                square += some.transpose(0, 2, 1) @ some
        return state.transpose(1, 0, 2).ravel(), square.ravel()

    return F.pandas_udf(compose, COMPOSED)


def _chainer(period: int):
    """UDF from a series' blocks in order (with the first two seasons' values among them),
    its points and the weights tried to the best of them and its final state."""

    def chain(blocks: pd.Series, total: pd.Series, weights: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(b, int(t), np.asarray(w, float).reshape(-1, 3))
                             for b, t, w in zip(blocks, total, weights)],
                            columns=["alpha", "beta", "gamma", "level", "trend", "season", "sse"])

    def one(blocks, total: int, weights: np.ndarray) -> tuple:
        n, size = len(weights), period + 2
        head = np.concatenate([np.asarray(b["head"], float) for b in blocks if b["head"] is not None])
        first, second = head[:period].sum() / period, head[period:2 * period].sum() / period
        start = np.concatenate(([first, (second - first) / period], head[:period] - first))
        state, error = np.tile(start, (n, 1)), np.zeros(n)
        for b in blocks:
            wide = np.concatenate((state, np.ones((n, 1))), axis=1)
            square = np.asarray(b["square"]).reshape(n, size + 1, size + 1)
            error += np.einsum("gi,gij,gj->g", wide, square, wide)
            state = np.einsum("gij,gj->gi", np.asarray(b["map"]).reshape(n, size, size + 1), wide)
        g = int(error.argmin())
        due = [float(state[g, 2 + (total + i) % period]) for i in range(period)]
        return (*map(float, weights[g]), state[g, 0], state[g, 1], due, error[g])

    return F.pandas_udf(chain, STATE)


def _next_weights(turn: int) -> Column:
    """The weights around those of ``state``, end to end, themselves first."""
    step = FIRST_STEP / 2 ** turn
    found = [F.greatest(F.lit(LEAST), F.least(F.lit(MOST), F.col("state")[name] + move * step))
             for moves in MOVES for name, move in zip(("alpha", "beta", "gamma"), moves)]
    return F.array(*found)


def _chained(packed: DataFrame, series: Sequence[str], value: Column, period: int,
             grid: Sequence[tuple[float, float, float]], search: int) -> DataFrame:
    """series, last and state of the series of several blocks."""
    y = F.transform("points", lambda p: F.coalesce(value(p), F.lit(0.0)))
    short = F.when(F.col("before") < 2 * period, F.slice("y", F.lit(1), F.least(
        F.lit(2 * period), F.size("y"))))
    blocks = packed.select(*series, F.col("__block").alias("block"), "before", "total", "last_point", y.alias("y"))
    blocks = blocks.withColumn("head", short)

    def best_of(weighted: DataFrame) -> DataFrame:
        done = weighted.withColumn("done", _composer(period)("y", "before", "weights"))
        lists = done.groupBy(*series).agg(
            F.array_sort(F.collect_list(F.struct("block", "head", "done.map", "done.square"))).alias("blocks"),
            F.first("total").alias("total"), F.first("last_point").alias("last"), F.first("weights").alias("weights"))
        # Without a key even no block at all gives a row.
        return lists.filter("total is not null").select(*series, "last", _chainer(period)("blocks", "total", "weights").alias("state"))

    flat = [float(w) for weights in grid for w in weights]
    best = best_of(blocks.withColumn("weights", F.array(*map(F.lit, flat))))
    for turn in range(search):
        again = best.select(*[F.col(c).alias(f"of_{c}") for c in series], _next_weights(turn).alias("weights"))
        same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in series]
        best = best_of(blocks.join(again, same) if same else blocks.join(F.broadcast(again)))
    return best


def fit(rows: DataFrame, series: Sequence[str] = (), ts: str = "window_start",
        value: str = "revenue", period: int = PERIOD,
        grid: Sequence[tuple[float, float, float]] = GRID, search: int = 0, block: str = BLOCK) -> DataFrame:
    """Best weights and final state per series of regular (densified) points.

    Of equally good weights the first in the grid count. ``search`` rounds then look around
    the best ones, by ever smaller steps: the error is never above the grid's. Series
    shorter than two seasons are left out.
    """
    rows = rows.filter(F.col(ts).isNotNull()).select(*series, ts, F.col(value).cast("double").alias(value))
    packed = in_blocks(rows, ts, series, block).filter(F.col("total") >= 2 * period)

    def own(point: Column) -> Column:
        return point["row"][value]

    whole = packed.filter("blocks = 1").select(
        *series, F.col("last_point").alias("last"),
        _fitter(period, grid, search=search)(F.transform("points", lambda p: F.coalesce(own(p), F.lit(0.0)))).alias("state"))
    return whole.unionByName(_chained(packed.filter("blocks > 1"), series, own, period, grid, search))


def history(rows: DataFrame, series: Sequence[str] = (), ts: str = "window_start",
            period: int = PERIOD) -> DataFrame:
    """Per series its ``points`` and ``status``: ``forecast``, or ``too_short`` for those
    under two seasons, which :func:`fit` leaves out."""
    points = F.count(ts)
    return (rows.groupBy(*series).agg(points.alias("points"))
                .withColumn("status", F.when(F.col("points") >= 2 * period, "forecast").otherwise("too_short")))


def forecast(rows: DataFrame, horizon: int = HORIZON, step: str = "1 minute",
             series: Sequence[str] = (), ts: str = "window_start", value: str = "revenue",
             period: int = PERIOD,
             grid: Sequence[tuple[float, float, float]] = GRID, search: int = 0, block: str = BLOCK) -> DataFrame:
    """``timestamp`` and ``predicted_revenue`` for the ``horizon`` steps after the last point."""
    models = fit(rows, series, ts, value, period, grid, search, block)
    ahead = F.col("ahead")
    season = F.element_at(F.col("state.season"), (ahead - 1) % period + 1)
    return (models.withColumn("ahead", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
                  .select(*series,
                          (F.col("last") + F.make_dt_interval(secs=ahead * seconds(step)))
                          .alias("timestamp"),
                          (F.col("state.level") + ahead * F.col("state.trend") + season)
                          .alias("predicted_revenue")))


def time_text(length: int) -> str:
    """Seconds in their largest whole unit, minutes at least: 1800 is ``30 minutes``."""
    for unit, size in (("day", 86_400), ("hour", 3_600), ("minute", 60)):
        if length % size == 0 or unit == "minute":
            number = length / size
            return f"{number:g} {unit}{'' if number == 1 else 's'}"


def forecast_summary(predicted: DataFrame, horizon: int = HORIZON, step: str = "1 minute",
                     series: Sequence[str] = ()) -> DataFrame:
    """Total forecast per series with its sentence; no row without a forecast."""
    return (predicted.groupBy(*series)
                     .agg(F.sum("predicted_revenue").alias("total_revenue"))
                     .filter(F.col("total_revenue").isNotNull())
                     .withColumn("summary", F.format_string(
                         SUMMARY, grouped(F.col("total_revenue")),
                         F.lit(time_text(horizon * seconds(step))))))
