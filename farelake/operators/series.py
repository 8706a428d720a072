"""Daily series for forecasting: training frame, features, hold-out, future dates and error measures.

Series are one row per day (and key), at most ten years long, so per-series windows are bounded.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelake.functions import fixed

#: Smallest denominator of a percentage error: the spacing of doubles at 1.
EPSILON = 2.0**-52

TIME_FEATURES = (
    "year",
    "month",
    "day",
    "dayofweek",
    "dayofyear",
    "weekofyear",
    "quarter",
    "is_weekend",
    "is_month_start",
    "is_month_end",
    "month_sin",
    "month_cos",
    "day_sin",
    "day_cos",
)


def training_frame(
    daily: DataFrame, metric: str = "total_trips", years: int = 2, as_of: dt.date | None = None
) -> DataFrame:
    """The last `years` years of the daily summary as (ds, y, regressors), up to `as_of` (today)."""
    if metric not in fixed.TARGET_METRICS:
        raise ValueError(f"unknown metric {metric!r}: expected one of {fixed.TARGET_METRICS}")
    low, high = fixed.TRAINING_YEARS_RANGE
    if not low <= years <= high:
        raise ValueError(f"years must be between {low} and {high}")
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    recent = F.col("pickup_date").between(F.add_months(today, -12 * years), today)
    return daily.filter(recent).select(
        F.col("pickup_date").alias("ds"),
        F.col(metric).cast("double").alias("y"),
        "year",
        "month",
        "day_of_week",
        "total_trips",
        "total_revenue",
        "avg_trip_revenue",
        "avg_distance_miles",
        "avg_duration_minutes",
    )


def time_features(df: DataFrame, ds: str = "ds") -> DataFrame:
    """Fourteen features of the date alone: all of them are known for future days."""
    d = F.col(ds)
    weekday = F.weekday(d)  # 0 = Monday

    def wave(fn, position: Column, period: int) -> Column:
        return fn(F.lit(2 * math.pi) * position / F.lit(float(period)))

    month = F.month(d)
    return df.withColumns(
        {
            "year": F.year(d),
            "month": month,
            "day": F.dayofmonth(d),
            "dayofweek": weekday,
            "dayofyear": F.dayofyear(d),
            "weekofyear": F.weekofyear(d),
            "quarter": F.quarter(d),
            "is_weekend": weekday.isin(5, 6).cast("int"),
            "is_month_start": (F.dayofmonth(d) == 1).cast("int"),
            "is_month_end": (d == F.last_day(d)).cast("int"),
            "month_sin": wave(F.sin, month, 12),
            "month_cos": wave(F.cos, month, 12),
            "day_sin": wave(F.sin, weekday, 7),
            "day_cos": wave(F.cos, weekday, 7),
        }
    )


def check_horizon(horizon: int) -> int:
    low, high = fixed.HORIZON_RANGE
    if not low <= horizon <= high:
        raise ValueError(f"horizon must be between {low} and {high} days")
    return horizon


def holdout_split(df: DataFrame, horizon: int, key: str | None = None) -> DataFrame:
    """Tag the last `horizon` rows of each series as validation (`is_validation`)."""
    series = Window.partitionBy(key) if key else Window.partitionBy()
    position = F.row_number().over(series.orderBy(F.col("ds").desc()))
    return df.withColumn("is_validation", position <= check_horizon(horizon))


def future_dates(df: DataFrame, horizon: int, key: str | None = None) -> DataFrame:
    """The `horizon` days after the last day of each series."""
    check_horizon(horizon)
    last = df.groupBy(*([key] if key else [])).agg(F.max("ds").alias("last"))
    days = F.sequence(F.date_add("last", 1), F.date_add("last", horizon))
    return last.filter(F.col("last").isNotNull()).select(*([key] if key else []), F.explode(days).alias("ds"))


def fill_days(df: DataFrame, key: str, value: str = "y") -> DataFrame:
    """Add the days a counted series lacks, as zeros: no trips on a day leave no row in the fact.

    All series end on the last day of any, so that forecasts of a quiet one start with those of the others.
    """
    last = df.agg(F.max("ds").alias("last")).scalar()
    spans = df.groupBy(key).agg(F.min("ds").alias("first"))
    every_day = spans.select(key, F.explode(F.sequence(F.col("first"), last)).alias("ds"))
    return every_day.join(df.select(key, "ds", value), [key, "ds"], "left").withColumn(
        value, F.coalesce(value, F.lit(0.0))
    )


def validation_frame(validation: DataFrame, predicted: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(ds, y_true, y_pred) of the held-out days; `predicted` has (ds, forecast)."""
    return validation.join(predicted, [*keys, "ds"]).select(
        *keys, "ds", F.col("y").alias("y_true"), F.col("forecast").alias("y_pred")
    )


def forecast_metrics(validation: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE and MAPE in percent, in one pass; true zeros divide by the smallest double step."""
    error = F.abs(F.col("y_true") - F.col("y_pred"))
    return validation.groupBy(*keys).agg(
        F.avg(error).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.avg(error / F.greatest(F.abs("y_true"), F.lit(EPSILON))) * F.lit(100.0)).alias("mape"),
    )


def future_frame(predicted: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(date, forecast) of the days ahead."""
    return predicted.select(*keys, F.col("ds").alias("date"), "forecast")


def future_summary(future: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return future.groupBy(*keys).agg(
        F.min("date").alias("forecast_start"),
        F.max("date").alias("forecast_end"),
        F.min("forecast").alias("min_forecast"),
        F.max("forecast").alias("max_forecast"),
        F.avg("forecast").alias("mean_forecast"),
    )
