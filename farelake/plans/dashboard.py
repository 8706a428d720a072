"""All read queries and chart frames of the dashboard, over stored gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farelake.functions import fixed
from farelake.operators import readlayer, reshape
from farelake.plans.gold import read_gold


def dashboard(
    spark: SparkSession,
    lake: str,
    zones: DataFrame | None = None,
    days: int | None = fixed.HISTORY_DAYS,
    min_trips: int = fixed.MIN_VALID_TRIPS,
    months: int | None = fixed.MONTHS_SHOWN,
    tip_months: int | None = fixed.TIP_MONTHS,
    top: int | None = fixed.TOP_ZONES,
) -> dict[str, DataFrame]:
    """Frame per chart. The last valid date is looked up once and passed to every query as a value.

    `days`, `months`, `tip_months` and `top` bound what single charts show; None shows everything. The zone map and
    the ranking see all zones.
    """
    gold = read_gold(spark, lake)
    last = readlayer.last_valid_date(gold["daily_summary"], min_trips=min_trips).first()[0]
    monthly = readlayer.monthly_trends_view(gold["monthly_trends"], last, limit=months)
    daily = readlayer.daily_view(gold["daily_summary"], last, days=days, min_trips=min_trips)
    payments = readlayer.payment_view(gold["payment_analysis"], last)
    locations = readlayer.location_view(gold["location_stats"], limit=None)
    frames = {
        "kpis": readlayer.kpi_summary(gold["daily_summary"], last),
        "monthly": reshape.monthly_series(monthly),
        "daily": reshape.daily_series(daily),
        "heatmap": reshape.heatmap_matrix(readlayer.hourly_view(gold["hourly_patterns"])),
        "payment_latest": reshape.payment_latest(payments),
        "tips": reshape.tip_last_12(payments, tip_months),
        "distance": readlayer.distance_view(gold["trip_distance_distribution"]),
        "vendors": reshape.vendor_series(readlayer.vendor_view(gold["vendor_comparison"], last)),
        "yoy": reshape.yoy_series(readlayer.yoy_view(gold["year_over_year"], last)),
        "top_zones": reshape.top_zones(locations, top),
    }
    if zones is not None:
        frames["zones"] = reshape.zone_activity(locations, zones)
    return frames
