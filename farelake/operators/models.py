"""Forecast models over daily series.

The additive and the boosted-tree model of one series are Spark ML regressions on date features. With a `key`, boosted
trees are one model over all series, and the others are fitted per series in Python workers, all series in
parallel; a series is one row per day over at most ten years, so a group is bounded however large the fact is. No
numeric parity with any particular statistics library is claimed.

Every model takes `train` (ds, y) and returns (ds, forecast) for the `horizon` days after it, or for `days`
(ds), the held-out rows of a series. Forecasts belong to dates: the days a series lacks are interpolated before a
recursive model is fitted. The recursive models also return `note`: a series that is too short for the model has
forecasts of NULL, and the note says so; no other model takes its place.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelake.operators.series import TIME_FEATURES, check_horizon, future_dates, time_features

WEEK = 7

# --- fixed values: settings of the boosted-tree model ----------------------------------------------
GBT_TREES = 200
GBT_DEPTH = 6
GBT_STEP = 0.1
GBT_ROW_SHARE = 0.8
GBT_COLUMN_SHARE = "0.8"
GBT_SEED = 42


def _dates(train: DataFrame, horizon: int, days: DataFrame | None) -> DataFrame:
    return future_dates(train, horizon) if days is None else days.select("ds")


def forecast_gbt(
    train: DataFrame, horizon: int, days: DataFrame | None = None, trees: int = GBT_TREES, key: str | None = None
) -> DataFrame:
    """Boosted trees on the date features only: anything measured on the day itself is unknown ahead.

    With a `key`, all series are one panel: their mean is one more feature, and what is learnt is the ratio to it.
    """
    if key:
        return _panel_gbt(train, horizon, days, trees, key)
    assembler = VectorAssembler(inputCols=list(TIME_FEATURES), outputCol="features")
    regressor = _trees(trees)
    # One row per day: a single partition keeps each of the many short passes to one task.
    known = time_features(train.select("ds", "y")).orderBy("ds").coalesce(1)
    model = Pipeline(stages=[assembler, regressor]).fit(known)
    return model.transform(time_features(_dates(train, horizon, days))).select("ds", "forecast")


def _trees(trees: int) -> GBTRegressor:
    return GBTRegressor(
        labelCol="y",
        predictionCol="forecast",
        maxIter=trees,
        maxDepth=GBT_DEPTH,
        stepSize=GBT_STEP,
        subsamplingRate=GBT_ROW_SHARE,
        featureSubsetStrategy=GBT_COLUMN_SHARE,
        seed=GBT_SEED,
    )


def _panel_gbt(train: DataFrame, horizon: int, days: DataFrame | None, trees: int, key: str) -> DataFrame:
    means = train.groupBy(key).agg(F.avg("y").alias("series_mean"))
    share = F.when(F.col("series_mean") != 0, F.col("y") / F.col("series_mean")).otherwise(F.col("y"))
    known = time_features(train.select(key, "ds", "y").join(means, key)).withColumn("y", share)
    asked = future_dates(train, horizon, key) if days is None else days.select(key, "ds")
    assembler = VectorAssembler(inputCols=[*TIME_FEATURES, "series_mean"], outputCol="features")
    model = Pipeline(stages=[assembler, _trees(trees)]).fit(known)
    ahead = model.transform(time_features(asked.join(means, key)))
    scaled = F.when(F.col("series_mean") != 0, F.col("forecast") * F.col("series_mean")).otherwise(F.col("forecast"))
    return ahead.select(key, "ds", scaled.alias("forecast"))


CHANGEPOINTS = 25
CHANGEPOINT_SPAN = 0.8
YEARLY_WAVES = 10
WEEKLY_WAVES = 3
YEAR_DAYS = 365.25


def additive_features(df: DataFrame, first_day, last_day) -> tuple[DataFrame, list[str]]:
    """Trend, trend bends and seasonal waves of the date as columns.

    Bends are spread evenly over the first part of the training span; the last of it, and everything
    ahead, continues on the latest slope.
    """
    day = F.datediff(F.col("ds"), F.lit(first_day))
    span = max((last_day - first_day).days, 1)
    t = day / F.lit(float(span))
    columns = {"trend": t}
    for i in range(1, CHANGEPOINTS + 1):
        bend = CHANGEPOINT_SPAN * i / (CHANGEPOINTS + 1)
        columns[f"bend_{i}"] = F.greatest(t - F.lit(bend), F.lit(0.0))
    for name, period, waves in (("year", YEAR_DAYS, YEARLY_WAVES), ("week", float(WEEK), WEEKLY_WAVES)):
        for k in range(1, waves + 1):
            angle = F.lit(2 * math.pi * k / period) * day
            columns[f"{name}_sin_{k}"] = F.sin(angle)
            columns[f"{name}_cos_{k}"] = F.cos(angle)
    return df.withColumns(columns), list(columns)


def additive_ahead(y: np.ndarray, steps: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    """The additive model of one series of consecutive days, at the given steps after its end."""
    span = max(len(y) - 1, 1)

    def features(day: np.ndarray) -> np.ndarray:
        t = day / span
        bends = [np.maximum(t - CHANGEPOINT_SPAN * i / (CHANGEPOINTS + 1), 0) for i in range(1, CHANGEPOINTS + 1)]
        waves = [
            wave(2 * math.pi * k / period * day)
            for period, many in ((YEAR_DAYS, YEARLY_WAVES), (float(WEEK), WEEKLY_WAVES))
            for k in range(1, many + 1) for wave in (np.sin, np.cos)
        ]
        return np.column_stack([t, *bends, *waves])

    x = features(np.arange(len(y), dtype=float))
    centre, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1
    z = (x - centre) / scale
    fit = np.linalg.solve(z.T @ z + ridge * len(y) * np.eye(z.shape[1]), z.T @ (y - y.mean()))
    return (features(len(y) - 1.0 + steps) - centre) / scale @ fit + y.mean()


def forecast_additive(
    train: DataFrame, horizon: int, days: DataFrame | None = None, ridge: float = 0.01, key: str | None = None
) -> DataFrame:
    """Bending trend plus yearly and weekly seasons, fitted by ridge regression: in one pass over one series, or for
    each series of a `key` by itself."""
    if key:
        ahead = lambda y, reach: (additive_ahead(y, np.arange(1, reach + 1), ridge), None)
        return _per_series(train, horizon, days, key, ahead).drop("note")
    span = train.agg(F.min("ds").alias("first"), F.max("ds").alias("last")).first()
    known, names = additive_features(train.select("ds", "y"), span["first"], span["last"])
    ahead, _ = additive_features(_dates(train, horizon, days), span["first"], span["last"])
    assembler = VectorAssembler(inputCols=names, outputCol="features")
    regression = LinearRegression(
        labelCol="y", predictionCol="forecast", regParam=ridge, elasticNetParam=0.0, solver="normal"
    )
    model = Pipeline(stages=[assembler, regression]).fit(known)
    return model.transform(ahead).select("ds", "forecast")


# --- recursive models, one series at a time ----------------------------------------------------------


def _per_series(
    train: DataFrame,
    horizon: int,
    days: DataFrame | None,
    key: str | None,
    ahead: Callable[[np.ndarray, int], tuple[np.ndarray | None, str | None]],
) -> DataFrame:
    check_horizon(horizon)
    name = key or "series"

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn(name, F.col(key) if key else F.lit("all"))

    rows = keyed(train).select(name, "ds", F.col("y").cast("double").alias("y"))
    kind = rows.schema[name].dataType.simpleString()
    reach = horizon
    if days is not None:  # held-out rows may lack days and so lie further ahead than their number
        ends = rows.groupBy(name).agg(F.max("ds").alias("last"))
        far = keyed(days).select(name, "ds").join(ends, name).agg(F.max(F.datediff("ds", "last"))).first()[0]
        reach = max(reach, far or 0)
    # Fitting costs far more than its few bytes of input suggest; a fixed partition count keeps AQE from
    # coalescing all series into one task. The grouping below reuses this partitioning. (A count equal
    # to that of a shuffle below would be optimised away, and the series coalesced after all.)
    spark = train.sparkSession
    tasks = 2 * spark.sparkContext.defaultParallelism
    rows = rows.repartition(tasks + (tasks == int(spark.conf.get("spark.sql.shuffle.partitions"))), name)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("ds")
        index = pd.DatetimeIndex(group["ds"])
        every_day = pd.Series(group["y"].to_numpy(dtype=float), index).reindex(pd.date_range(index[0], index[-1])).interpolate()
        forecast, note = ahead(every_day.to_numpy(), reach)
        dates = pd.date_range(index[-1] + pd.Timedelta(days=1), periods=reach)
        return pd.DataFrame(
            {
                name: group[name].iloc[0],
                "ds": dates.date,
                "forecast": np.full(reach, np.nan) if forecast is None else forecast,
                "note": note,
            }
        )

    predicted = rows.groupBy(name).applyInPandas(run, f"`{name}` {kind}, ds date, forecast double, note string")
    predicted = predicted.withColumn("forecast", F.nanvl("forecast", F.lit(None).cast("double")))
    if days is not None:
        predicted = keyed(days).select(name, "ds").join(predicted, [name, "ds"])
    return predicted.select(*([key] if key else []), "ds", "forecast", "note")


def _too_short(days: int, needed: int) -> tuple[None, str]:
    return None, f"too short: {days} days of at least {needed}"


# --- fixed values: smoothing settings that are tried -------------------------------------------------
HW_LEVEL = (0.05, 0.1, 0.2, 0.35, 0.5, 0.8)
HW_TREND = (0.0, 0.01, 0.05, 0.1, 0.3)
HW_SEASON = (0.01, 0.05, 0.1, 0.3)
HW_DAMPING = (0.8, 0.9, 0.98)


def holtwinters_ahead(y: np.ndarray, horizon: int) -> tuple[np.ndarray | None, str | None]:
    """Additive damped trend and additive week; the settings with the least squared one-step error win.

    All settings advance together as vectors, so a series costs one pass over its days.
    """
    if len(y) < 3 * WEEK:
        return _too_short(len(y), 3 * WEEK)
    grid = np.array(list(itertools.product(HW_LEVEL, HW_TREND, HW_SEASON, HW_DAMPING)))
    alpha, beta, gamma, phi = grid.T
    head = y[: 2 * WEEK].reshape(2, WEEK)
    level = np.full(len(grid), head[0].mean())
    trend = np.full(len(grid), (head[1].mean() - head[0].mean()) / WEEK)
    profile = (head - head.mean(axis=1, keepdims=True)).mean(axis=0)
    season = np.repeat(profile[:, None], len(grid), axis=1)
    squares = np.zeros(len(grid))
    trend_gain, season_gain = alpha * beta, gamma * (1 - alpha)
    for i, value in enumerate(y):
        drift = phi * trend
        expected = level + drift
        error = value - expected - season[i % WEEK]
        squares += error * error
        level = expected + alpha * error
        trend = drift + trend_gain * error
        season[i % WEEK] += season_gain * error
    best = int(np.argmin(squares))
    damping = np.cumsum(phi[best] ** np.arange(1, horizon + 1))
    weekdays = (len(y) + np.arange(horizon)) % WEEK
    return level[best] + damping * trend[best] + season[weekdays, best], None


def forecast_holtwinters(
    train: DataFrame, horizon: int, days: DataFrame | None = None, key: str | None = None
) -> DataFrame:
    return _per_series(train, horizon, days, key, holtwinters_ahead)


SARMA_LAGS = (1, 7, 8)
SARMA_LONG_LAGS = 15


def _lagged(x: np.ndarray, lags, start: int) -> np.ndarray:
    return np.column_stack([x[start - lag : len(x) - lag] for lag in lags])


def sarma_ahead(y: np.ndarray, horizon: int) -> tuple[np.ndarray | None, str | None]:
    """ARMA terms at lags 1, 7 and 8 on the series differenced by one day and one week.

    Two-stage least squares (Hannan and Rissanen, 1982): a long autoregression yields the innovations,
    which then stand beside the lagged values as regressors. Steps ahead are unrolled one by one.
    """
    w = np.diff(y)
    w = w[WEEK:] - w[:-WEEK]
    start = SARMA_LONG_LAGS + max(SARMA_LAGS)
    if len(w) < 3 * start:
        return _too_short(len(y), 3 * start + WEEK + 1)
    long_x = _lagged(w, range(1, SARMA_LONG_LAGS + 1), SARMA_LONG_LAGS)
    long_fit = np.linalg.lstsq(long_x, w[SARMA_LONG_LAGS:], rcond=None)[0]
    shocks = np.concatenate([np.zeros(SARMA_LONG_LAGS), w[SARMA_LONG_LAGS:] - long_x @ long_fit])
    x = np.hstack([_lagged(w, SARMA_LAGS, start), _lagged(shocks, SARMA_LAGS, start)])
    # A little shrinkage keeps the recursion from running away on short noisy series.
    shrink = 1e-3 * np.trace(x.T @ x) / x.shape[1] * np.eye(x.shape[1])
    # A perfectly regular series has no differences and nothing to fit; least squares then gives zeros.
    fit = np.linalg.lstsq(x.T @ x + shrink, x.T @ w[start:], rcond=None)[0]
    series, diffs, noise = list(y), list(w), list(shocks)
    for _ in range(horizon):
        step = np.dot(fit, [*(diffs[-lag] for lag in SARMA_LAGS), *(noise[-lag] for lag in SARMA_LAGS)])
        diffs.append(step)
        noise.append(0.0)
        series.append(step + series[-1] + series[-WEEK] - series[-WEEK - 1])
    return np.array(series[len(y) :]), None


def forecast_sarma(
    train: DataFrame, horizon: int, days: DataFrame | None = None, key: str | None = None
) -> DataFrame:
    return _per_series(train, horizon, days, key, sarma_ahead)


MODELS: dict[str, Callable[..., DataFrame]] = {
    "additive": forecast_additive,
    "sarma": forecast_sarma,
    "gbt": forecast_gbt,
    "holtwinters": forecast_holtwinters,
}
