"""Parameterised read queries over the gold tables.

Each takes the gold frame and, where the result ends at the last plausible day, `last_valid`: a date, a
one-row frame from `last_valid_date`, or None for no limit. A frame is used as a scalar subquery, so
nothing runs until the result is asked for; a caller serving many reads passes the date instead.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.functions import fixed

LastValid = dt.date | DataFrame | None


def _plausible(min_trips: int, low: float, high: float) -> Column:
    return (
        (F.col("total_trips") > min_trips)
        & (F.col("total_revenue") > 0)
        & F.col("avg_trip_revenue").between(low, high)
    )


def last_valid_date(
    daily: DataFrame,
    min_trips: int = fixed.MIN_VALID_TRIPS,
    low: float = fixed.MIN_AVG_REVENUE,
    high: float = fixed.MAX_AVG_REVENUE,
) -> DataFrame:
    """One row: the latest day whose volume and revenue look real (NULL if there is none)."""
    return daily.filter(_plausible(min_trips, low, high)).agg(F.max("pickup_date").alias("last_valid_date"))


def last_valid_month(last_valid: DataFrame) -> DataFrame:
    """The same as 'YYYY-MM'."""
    return last_valid.select(F.date_format("last_valid_date", "yyyy-MM").alias("last_valid_month"))


def _until(df: DataFrame, column: Column, last_valid: LastValid, part) -> DataFrame:
    """Rows up to `part` of the last valid date; all rows if there is no such date."""
    if last_valid is None:
        return df
    if isinstance(last_valid, DataFrame):
        limit = part(F.col("last_valid_date"))
        limit = last_valid.select(limit.alias("last_valid")).scalar()
        return df.filter(limit.isNull() | (column <= limit))
    return df.filter(column <= part(F.lit(last_valid).cast("date")))


def _day(day: Column) -> Column:
    return day


def _month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def kpi_summary(daily: DataFrame, last_valid: LastValid = None) -> DataFrame:
    """One row of totals; the two averages are plain means of the daily means."""
    days = daily.filter((F.col("total_trips") > 0) & (F.col("total_revenue") > 0))
    days = _until(days, F.col("pickup_date"), last_valid, _day)

    def or_zero(aggregate: Column, kind: str) -> Column:
        return F.coalesce(aggregate, F.lit(0).cast(kind))

    return days.agg(
        or_zero(F.sum("total_trips"), "bigint").alias("total_trips"),
        or_zero(F.sum("total_revenue"), "double").alias("total_revenue"),
        or_zero(F.sum("total_distance_miles"), "double").alias("total_distance"),
        or_zero(F.avg("avg_trip_revenue"), "double").alias("avg_fare"),
        or_zero(F.avg("avg_tip"), "double").alias("avg_tip"),
        F.min("pickup_date").alias("data_start_date"),
        F.max("pickup_date").alias("data_end_date"),
        F.countDistinct("pickup_date").alias("total_days"),
    )


def _first(ordered: DataFrame, limit: int | None) -> DataFrame:
    """The first `limit` rows; all, if it is None."""
    return ordered if limit is None else ordered.limit(limit)


def monthly_trends_view(
    monthly: DataFrame, last_valid: LastValid = None, limit: int | None = fixed.MONTHS_SHOWN
) -> DataFrame:
    rows = monthly.filter((F.col("total_trips") > 0) & (F.col("total_revenue") > 0))
    rows = _until(rows, F.col("year_month"), last_valid, _month)
    return _first(
        rows.select(
            "year_month",
            "year",
            "month",
            "total_trips",
            "total_revenue",
            "fare_revenue",
            "tip_revenue",
            "avg_daily_trips",
            "revenue_per_trip",
            F.col("revenue_per_trip").alias("avg_fare"),
            "avg_distance",
            "avg_duration",
        ).orderBy(F.col("year").desc(), F.col("month").desc()),
        limit,
    )


def daily_view(
    daily: DataFrame,
    last_valid: LastValid = None,
    days: int | None = fixed.DAYS_SHOWN,
    min_trips: int = fixed.MIN_VALID_TRIPS,
    low: float = fixed.MIN_AVG_REVENUE,
    high: float = fixed.MAX_AVG_REVENUE,
) -> DataFrame:
    rows = daily.filter(_plausible(min_trips, low, high))
    rows = _until(rows, F.col("pickup_date"), last_valid, _day)
    return _first(
        rows.select(
            "pickup_date",
            "year",
            "month",
            "day_of_week",
            "total_trips",
            "total_revenue",
            "avg_distance_miles",
            "avg_duration_minutes",
            "avg_trip_revenue",
            "avg_tip",
            "credit_card_trips",
            "cash_trips",
        ).orderBy(F.col("pickup_date").desc()),
        days,
    )


def hourly_view(hourly: DataFrame) -> DataFrame:
    return hourly.select(
        "pickup_hour",
        "pickup_day_of_week",
        "day_name",
        "day_type",
        "total_trips",
        "avg_distance",
        "avg_duration",
        "avg_fare",
        "avg_tip",
        "avg_speed",
    ).orderBy("pickup_day_of_week", "pickup_hour")


def _positive_months(table: DataFrame, last_valid: LastValid) -> DataFrame:
    rows = table.filter((F.col("trip_count") > 0) & (F.col("total_revenue") > 0))
    return _until(rows, F.col("year_month"), last_valid, _month)


def payment_view(payments: DataFrame, last_valid: LastValid = None) -> DataFrame:
    return (
        _positive_months(payments, last_valid)
        .select(
            "year_month",
            "year",
            "month",
            "payment_type_name",
            "trip_count",
            "total_revenue",
            "avg_fare",
            "avg_tip",
            "avg_tip_pct",
            "pct_of_monthly_trips",
        )
        .orderBy(F.col("year").desc(), F.col("month").desc(), F.col("trip_count").desc())
    )


def distance_view(bands: DataFrame) -> DataFrame:
    return bands.select(
        "distance_bucket",
        "bucket_order",
        "trip_count",
        "pct_of_total",
        "avg_duration_minutes",
        "avg_fare",
        "avg_tip",
        "total_revenue",
    ).orderBy("bucket_order")


def location_view(locations: DataFrame, limit: int | None = fixed.ZONES_SHOWN) -> DataFrame:
    """The busiest zones; zones sharing a rank are taken in id order, so the cut is repeatable. What is computed from
    it should pass `limit=None`."""
    return _first(
        locations.select(
            "location_id",
            "pickup_trips",
            "dropoff_trips",
            "total_trips",
            "total_revenue",
            "avg_fare",
            "popularity_rank",
        ).orderBy(F.col("popularity_rank"), F.col("location_id").asc_nulls_last()),
        limit,
    )


def vendor_view(vendors: DataFrame, last_valid: LastValid = None) -> DataFrame:
    return (
        _positive_months(vendors, last_valid)
        .select(
            "year_month",
            "year",
            "month",
            "vendor_name",
            "trip_count",
            "total_revenue",
            "avg_distance",
            "avg_duration",
            "avg_fare",
            "avg_tip",
            "market_share_pct",
        )
        .orderBy(F.col("year").desc(), F.col("month").desc(), "vendor_name")
    )


def yoy_view(yearly: DataFrame, last_valid: LastValid = None) -> DataFrame:
    rows = yearly.filter((F.col("total_trips") > 0) & (F.col("total_revenue") > 0))
    rows = _until(rows, F.col("year"), last_valid, F.year)
    return rows.select(
        "year",
        "total_trips",
        "total_revenue",
        "total_tips",
        "avg_distance",
        "avg_duration",
        "avg_fare",
        "trips_yoy_change_pct",
        "revenue_yoy_change_pct",
    ).orderBy("year")
