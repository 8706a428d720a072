"""Column expressions over dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farelake.functions import fixed


def year(day: Column) -> Column:
    return F.year(day).cast("bigint")


def month(day: Column) -> Column:
    return F.month(day).cast("bigint")


def day_of_week(day: Column) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(day).cast("bigint")


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def sunday_week(day: Column) -> Column:
    """Week number with weeks starting on Sunday; days before the first Sunday are week 0."""
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("bigint")


def fiscal_year(day: Column) -> Column:
    """The fiscal year, named after the calendar year in which it ends."""
    return (F.year(day) + (F.month(day) >= fixed.FISCAL_YEAR_FIRST_MONTH).cast("int")).cast("bigint")


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(*fixed.WEEKEND_DAYS)
