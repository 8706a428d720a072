"""Frames shaped the way charts consume them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.functions import fixed, labels
from farelake.functions.sizing import broadcast_if_small


def zone_lookup(df: DataFrame, zones: DataFrame, key: str = "location_id") -> DataFrame:
    """Add `zone_name` and `borough`; ids the zone file does not know get 'Zone {id}' and 'Unknown'."""
    known = broadcast_if_small(
        zones.select(F.col("location_id").alias(key), F.col("zone").alias("_zone"), F.col("borough").alias("_borough"))
    )
    joined = df.join(known, key, "left")
    fallback = F.concat(F.lit("Zone "), F.col(key).cast("string"))
    return joined.withColumns(
        {
            "zone_name": F.coalesce("_zone", fallback),
            "borough": F.coalesce("_borough", F.lit("Unknown")),
        }
    ).drop("_zone", "_borough")


def heatmap_matrix(hourly: DataFrame) -> DataFrame:
    """Weekday by hour, Monday first. The 24 pivot values are given, so no job is spent finding them."""
    wide = hourly.groupBy("day_name").pivot("pickup_hour", list(range(24))).agg(F.sum("total_trips"))
    named = wide.select("day_name", *[F.col(str(h)).alias(f"h{h:02d}") for h in range(24)])
    return named.withColumn("day_order", labels.display_day_order(F.col("day_name"))).orderBy("day_order")


def payment_latest(payments: DataFrame) -> DataFrame:
    """Rows of the latest month present."""
    latest = payments.agg(F.max("year_month").alias("latest")).scalar()
    return payments.filter(F.col("year_month") == latest)


def vendor_series(vendors: DataFrame) -> DataFrame:
    """Market share per vendor, each series in month order."""
    return vendors.select("vendor_name", "year_month", "year", "month", "market_share_pct").orderBy(
        "vendor_name", "year", "month"
    )


def tip_last_12(payments: DataFrame, months: int | None = fixed.TIP_MONTHS) -> DataFrame:
    """Per payment type over the latest months (all, if None): plain means of the monthly tip figures, and trips."""
    recent = payments
    if months is not None:
        latest = payments.select("year_month").distinct().orderBy(F.col("year_month").desc()).limit(months)
        recent = payments.join(F.broadcast(latest), "year_month", "left_semi")  # at most `months` rows
    return recent.groupBy("payment_type_name").agg(
        F.avg("avg_tip").alias("avg_tip"),
        F.avg("avg_tip_pct").alias("avg_tip_pct"),
        F.sum("trip_count").alias("trip_count"),
    )


def top_zones(locations: DataFrame, n: int | None = fixed.TOP_ZONES) -> DataFrame:
    """The `n` busiest zones, or all in order."""
    ordered = locations.orderBy(F.col("popularity_rank"), F.col("location_id").asc_nulls_last())
    return (ordered if n is None else ordered.limit(n)).select(
        "location_id", "pickup_trips", "dropoff_trips", "popularity_rank"
    )


def zone_activity(locations: DataFrame, zones: DataFrame) -> DataFrame:
    """Zone statistics with names, as a map needs them."""
    return zone_lookup(locations, zones)


def forecast_band(future: DataFrame, low: float = fixed.BAND_LOW, high: float = fixed.BAND_HIGH) -> DataFrame:
    return future.withColumns({"lower": F.col("forecast") * F.lit(low), "upper": F.col("forecast") * F.lit(high)})


def accuracy_points(validation: DataFrame) -> DataFrame:
    """Actual and predicted pairs with the ends of the diagonal they are drawn against."""
    span = validation.agg(
        F.least(F.min("y_true"), F.min("y_pred")).alias("lo"),
        F.greatest(F.max("y_true"), F.max("y_pred")).alias("hi"),
    )
    return validation.select(
        "y_true",
        "y_pred",
        span.select("lo").scalar().alias("diagonal_min"),
        span.select("hi").scalar().alias("diagonal_max"),
    )


def best_per_model(comparison: DataFrame, by_metric: bool = False) -> DataFrame:
    """The run with the lowest MAPE per model type (and target metric, if asked for).

    The smallest struct wins, with unknown errors last; of equal runs the newest, then the lowest id. A
    minimum combines on the map side, which a per-model window sort would not. All values come from
    that one run; a field it lacks stays NULL rather than being filled from another run.
    """
    keys = ["model_type", "target_metric"] if by_metric else ["model_type"]
    values = [c for c in comparison.columns if c not in keys]
    newest = (-F.unix_micros("start_time")).alias("_newest")
    order = [F.col("mape").isNull().alias("_unknown"), "mape", newest, "run_id", "start_time"]
    rest = [c for c in values if c not in ("mape", "start_time", "run_id")]
    best = comparison.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("best"))
    return best.select(*keys, *[F.col(f"best.{c}").alias(c) for c in values])


def runs_history(runs: DataFrame) -> DataFrame:
    """MAPE by start time, one series per model type."""
    return runs.select("model_type", "start_time", "mape", "run_id").orderBy(
        "model_type", "start_time", "run_id"
    )


def monthly_series(monthly_view: DataFrame) -> DataFrame:
    return monthly_view.orderBy("year", "month")


def daily_series(daily_view: DataFrame) -> DataFrame:
    return daily_view.orderBy("pickup_date")


def yoy_series(yoy_view: DataFrame) -> DataFrame:
    return yoy_view.select("year", "total_trips", "total_revenue").orderBy("year")
