"""The five dimensions and the star join."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.functions import calendar, fixed, labels


def _code_dimension(stg: DataFrame, key: str, name: str, table: Mapping[int, str], default: str) -> DataFrame:
    # DISTINCT combines on the map side, so a hot code costs one row per task.
    codes = stg.select(key).filter(F.col(key).isNotNull()).distinct()
    return codes.withColumn(name, labels.code_label(F.col(key), table, default))


def dim_vendor(stg: DataFrame) -> DataFrame:
    return _code_dimension(
        stg, "vendor_id", "vendor_name", fixed.VENDOR_DIM_LABELS, fixed.VENDOR_DIM_DEFAULT
    )


def dim_payment_type(stg: DataFrame) -> DataFrame:
    return _code_dimension(
        stg, "payment_type_id", "payment_type_name", fixed.PAYMENT_DIM_LABELS, fixed.PAYMENT_DIM_DEFAULT
    )


def dim_rate_code(stg: DataFrame) -> DataFrame:
    return _code_dimension(
        stg, "rate_code_id", "rate_code_name", fixed.RATE_CODE_LABELS, fixed.RATE_CODE_DEFAULT
    )


def calendar_columns(days: DataFrame, day: str = "date_key") -> DataFrame:
    """Thirteen calendar attributes for a frame holding one date per row."""
    d = F.col(day)
    return days.select(
        d.alias("date_key"),
        calendar.year(d).alias("year"),
        F.quarter(d).cast("bigint").alias("quarter"),
        calendar.month(d).alias("month"),
        calendar.sunday_week(d).alias("week_of_year"),
        F.dayofmonth(d).cast("bigint").alias("day_of_month"),
        calendar.day_of_week(d).alias("day_of_week"),
        labels.day_name(F.dayofweek(d)).alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
        calendar.year_month(d).alias("year_month"),
        F.date_format(d, "yyyy-'Q'Q").alias("year_quarter"),
        calendar.fiscal_year(d).alias("fiscal_year"),
        calendar.is_weekend(d).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    )


def date_spine(bounds: DataFrame, first: Column, last: Column) -> DataFrame:
    """Every day from `first` to `last`, both taken from the one-row frame `bounds`."""
    return bounds.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date_key"))


def dim_date(
    spark: SparkSession, start: str = fixed.CALENDAR_START, end: str = fixed.CALENDAR_END
) -> DataFrame:
    one = spark.range(1)
    return calendar_columns(date_spine(one, F.lit(start).cast("date"), F.lit(end).cast("date")))


def dim_date_of(fct: DataFrame) -> DataFrame:
    """The calendar over exactly the span of the stored trips."""
    span = fct.agg(F.min("pickup_date").alias("first"), F.max("pickup_date").alias("last"))
    span = span.filter(F.col("first").isNotNull())
    return calendar_columns(date_spine(span, F.col("first"), F.col("last")))


def dim_time(spark: SparkSession) -> DataFrame:
    hour = F.col("id")
    rush = F.lit(False)
    for first, last in fixed.RUSH_HOURS:
        rush = rush | hour.between(first, last)
    return spark.range(24).select(
        hour.alias("hour_key"),
        hour.alias("hour_of_day"),
        labels.hour_range_label(hour, fixed.TIME_PERIODS, fixed.TIME_PERIOD_DEFAULT).alias("time_period"),
        rush.alias("is_rush_hour"),
        labels.hour_range_label(hour, fixed.PEAK_CATEGORIES, fixed.PEAK_CATEGORY_DEFAULT).alias(
            "peak_category"
        ),
        F.format_string("%02d:00", hour).alias("hour_display"),
        F.format_string("%02d:00 - %02d:59", hour, hour).alias("hour_range"),
    )


def star_trips(
    fct: DataFrame,
    vendors: DataFrame,
    payment_types: DataFrame,
    rate_codes: DataFrame,
    dates: DataFrame,
    hours: DataFrame,
) -> DataFrame:
    """The fact with its labels and calendar attributes; every trip is kept.

    No broadcast is forced: the dimensions are tiny, so the planner broadcasts them from their measured
    size, and a dimension that is not tiny gets a shuffled join instead of exhausting the driver.
    """
    dates = dates.select(
        F.col("date_key").alias("pickup_date"),
        F.col("day_name").alias("pickup_day_name"),
        F.col("fiscal_year").alias("pickup_fiscal_year"),
        F.col("is_weekend").alias("pickup_is_weekend"),
    )
    hours = hours.select(
        F.col("hour_key").alias("pickup_hour"), "time_period", "is_rush_hour", "peak_category"
    )
    return (
        fct.join(vendors, "vendor_id", "left")
        .join(payment_types, "payment_type_id", "left")
        .join(rate_codes, "rate_code_id", "left")
        .join(dates, "pickup_date", "left")
        .join(hours, "pickup_hour", "left")
    )
