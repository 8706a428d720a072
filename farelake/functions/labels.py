"""Column expressions for labels, bands and number formats."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from farelake.functions import fixed


def code_label(code: Column, labels: Mapping[int, str], default: str | None = None) -> Column:
    """The label of a numeric code; codes without one, and NULL, get `default`."""
    chain = F
    for value, label in labels.items():
        chain = chain.when(code == value, F.lit(label))
    return chain.otherwise(F.lit(default))


def day_name(day_of_week: Column) -> Column:
    """Weekday name of a Sunday-based day number."""
    return code_label(day_of_week, fixed.DAY_NAMES)


def day_type(day_of_week: Column) -> Column:
    return F.when(day_of_week.isin(*fixed.WEEKEND_DAYS), "Weekend").otherwise("Weekday")


def display_day_order(name: Column) -> Column:
    """Position of a weekday name in a Monday-first week, from 1."""
    return F.array_position(F.array(*[F.lit(d) for d in fixed.DISPLAY_DAY_ORDER]), name)


def hour_range_label(hour: Column, ranges: Mapping[str, tuple[int, int]], default: str) -> Column:
    chain = F
    for label, (first, last) in ranges.items():
        chain = chain.when(hour.between(first, last), F.lit(label))
    return chain.otherwise(F.lit(default))


def distance_bucket(distance: Column) -> Column:
    """Band label. As in a CASE with ELSE, an unknown distance lands in the open last band."""
    chain = F
    for label, upper in fixed.DISTANCE_BANDS:
        chain = chain.when(distance < upper, F.lit(label))
    return chain.otherwise(F.lit(fixed.DISTANCE_BAND_LAST))


def bucket_order(distance: Column) -> Column:
    chain = F
    for position, (_, upper) in enumerate(fixed.DISTANCE_BANDS, start=1):
        chain = chain.when(distance < upper, F.lit(position).cast("bigint"))
    return chain.otherwise(F.lit(len(fixed.DISTANCE_BANDS) + 1).cast("bigint"))


def compact_number(value: Column, decimals: int = 0) -> Column:
    """1234567 -> '1.2M' (with one decimal): thousands, millions and billions get a suffix."""
    pattern = f"%.{decimals}f"
    number = value.cast("double")
    chain = F
    for size, suffix in ((1e9, "B"), (1e6, "M"), (1e3, "K")):
        chain = chain.when(number >= size, F.format_string(pattern + suffix, number / size))
    return F.when(number.isNull(), F.lit(None).cast("string")).otherwise(
        chain.otherwise(F.format_string(pattern, number))
    )


def mape_grade(mape: Column) -> Column:
    """good / fair / poor by percentage error; no grade where the run has no error recorded."""
    return (
        F.when(mape.isNull(), F.lit(None).cast("string"))
        .when(mape < fixed.MAPE_GOOD, "good")
        .when(mape < fixed.MAPE_FAIR, "fair")
        .otherwise("poor")
    )
