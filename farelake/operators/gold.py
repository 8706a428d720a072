"""The eight gold tables.

Every table is a partial-then-final hash aggregate over a pruned scan of the fact: what crosses the
network is one row per group and map task, so a day, zone or vendor holding a large share of all trips
costs no more than any other. Windows only ever run over aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelake.functions import calendar, fixed, labels


#: Size of the sketches that medians come from. Of fewer trips they are exact; else the rank is off by about 1/500, with
#: at most 50 KB a day and measure.
MEDIAN_K = 2000


def clean_trips(fct: DataFrame) -> DataFrame:
    return fct.filter(~F.col("has_data_quality_issue"))


def _tip_share() -> Column:
    return F.try_divide(F.col("tip_amount"), F.col("fare_amount")) * F.lit(100.0)


def _percent(part: Column, whole: Column) -> Column:
    return F.round(part * F.lit(100.0) / whole, 2)


# --- rollups -------------------------------------------------------------------------------------

#: rollup column -> trip column; each is kept as sum and count of known values, so any coarser mean
#: is exact.
_ROLLUP_MEASURES = {
    "distance": "trip_distance_miles",
    "duration": "trip_duration_minutes",
    "amount": "total_amount",
    "fare": "fare_amount",
    "tip": "tip_amount",
    "speed": "avg_speed_mph",
    "passengers": "passenger_count",
}


def clean_rollup(fct: DataFrame, *keys: str) -> DataFrame:
    """Sums and counts of clean trips per pickup date and `keys`.

    All tables but the daily one are finished from a rollup: on the fly, where unused measures are
    pruned away, or from stored rollups, of which a reload has to renew only the months it touched.
    """
    aggregates = [F.count(F.lit(1)).alias("trips")]
    for name, column in _ROLLUP_MEASURES.items():
        aggregates += [F.sum(column).alias(f"{name}_sum"), F.count(column).alias(f"{name}_n")]
    aggregates += [F.sum(_tip_share()).alias("tip_pct_sum"), F.count(_tip_share()).alias("tip_pct_n")]
    return clean_trips(fct).groupBy("pickup_date", *keys).agg(*aggregates)


ROLLUP_KEYS = ("vendor_id", "payment_type_id")


def _mean(name: str) -> Column:
    return F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n"))


# --- per day --------------------------------------------------------------------------------------


def _zone_bits(column: str) -> tuple[Column, Column]:
    """The bitmap that a zone id belongs to, and the bitmap of all ids there. Null ids are in none."""
    return F.bitmap_bucket_number(column), F.bitmap_construct_agg(F.bitmap_bit_position(column))


def day_rollup(fct: DataFrame, median_k: int = MEDIAN_K) -> DataFrame:
    """All trips, flagged ones included, by pickup date and zone bitmaps: sums, counts, sketches and sets of zones.

    Everything in it can be merged, so days, months and years are finished from it without the fact: means and
    sums exactly, numbers of different zones exactly (as bitmaps of 32,768 ids), medians from sketches. As one
    bitmap holds the ids of all zones there are, a day is one row; ids beyond give it more.
    """
    pickup, pickup_bits = _zone_bits("pickup_location_id")
    dropoff, dropoff_bits = _zone_bits("dropoff_location_id")
    plain = {
        "passengers": "passenger_count", "distance": "trip_distance_miles", "duration": "trip_duration_minutes",
        "amount": "total_amount", "fare": "fare_amount", "tip": "tip_amount", "tolls": "tolls_amount",
    }
    return fct.groupBy("pickup_date", pickup.alias("pickup_map"), dropoff.alias("dropoff_map")).agg(
        F.count(F.lit(1)).alias("trips"),
        *(F.sum(column).alias(f"{name}_sum") for name, column in plain.items()),
        *(F.count(plain[name]).alias(f"{name}_n") for name in ("distance", "duration", "amount", "tip")),
        F.sum(_tip_share()).alias("tip_pct_sum"),
        F.count(_tip_share()).alias("tip_pct_n"),
        F.count_if(F.col("payment_type_id") == 1).alias("card_trips"),
        F.count_if(F.col("payment_type_id") == 2).alias("cash_trips"),
        F.count_if("has_data_quality_issue").alias("issues"),
        F.kll_sketch_agg_double("trip_distance_miles", median_k).alias("distances"),
        F.kll_sketch_agg_bigint("trip_duration_minutes", median_k).alias("durations"),
        pickup_bits.alias("pickup_zones"),
        dropoff_bits.alias("dropoff_zones"),
    )


def _median(sketch: str, kind: str) -> Column:
    n, quantile = getattr(F, f"kll_sketch_get_n_{kind}"), getattr(F, f"kll_sketch_get_quantile_{kind}")
    return F.when(n(sketch) > 0, quantile(sketch, F.lit(0.5)))


def period_summary_from(rollup: DataFrame, period: Column, name: str) -> DataFrame:
    """The measures of the daily table per `period` of the pickup date, as column `name`, from a `day_rollup`.

    Zones count once per period: the bitmaps of one range of ids are united, and their sizes added up. That needs the
    period's few rows together, but neither a join nor a second pass.
    """
    rows = rollup.withColumn(name, period)

    def zones(end: str) -> Column:
        own = Window.partitionBy(name, f"{end}_map")
        first = F.row_number().over(own.orderBy("pickup_date", "pickup_map", "dropoff_map")) == 1
        return F.when(first & F.col(f"{end}_map").isNotNull(), F.bitmap_count(F.bitmap_or_agg(f"{end}_zones").over(own)))

    sums = [c for c in rollup.columns if c.endswith(("_sum", "_n"))]
    counted = rows.repartition(name).withColumn("pickup_ids", zones("pickup")).withColumn("dropoff_ids", zones("dropoff"))
    whole = counted.groupBy(name).agg(
        *(F.sum(c).alias(c) for c in (*sums, "trips", "card_trips", "cash_trips", "issues")),
        *(F.coalesce(F.sum(f"{end}_ids"), F.lit(0)).alias(f"unique_{end}_locations") for end in ("pickup", "dropoff")),
        F.kll_merge_agg_double("distances").alias("distances"),
        F.kll_merge_agg_bigint("durations").alias("durations"),
    )

    def mean(measure: str) -> Column:
        return F.try_divide(F.col(f"{measure}_sum"), F.col(f"{measure}_n"))

    return whole.select(
        name,
        F.col("trips").alias("total_trips"),
        F.col("passengers_sum").alias("total_passengers"),
        "unique_pickup_locations",
        "unique_dropoff_locations",
        F.col("distance_sum").alias("total_distance_miles"),
        mean("distance").alias("avg_distance_miles"),
        _median("distances", "double").alias("median_distance_miles"),
        F.col("duration_sum").alias("total_duration_minutes"),
        mean("duration").alias("avg_duration_minutes"),
        _median("durations", "bigint").alias("median_duration_minutes"),
        F.col("amount_sum").alias("total_revenue"),
        F.col("fare_sum").alias("total_fare_revenue"),
        F.col("tip_sum").alias("total_tips"),
        F.col("tolls_sum").alias("total_tolls"),
        mean("amount").alias("avg_trip_revenue"),
        mean("tip").alias("avg_tip"),
        mean("tip_pct").alias("avg_tip_percentage"),
        F.col("card_trips").alias("credit_card_trips"),
        "cash_trips",
        F.col("issues").alias("trips_with_issues"),
        F.round(F.col("issues") / F.col("trips") * 100, 2).alias("pct_trips_with_issues"),
    )


def daily_summary_from(rollup: DataFrame) -> DataFrame:
    """One row per pickup date over all trips, flagged ones included."""
    day = F.col("pickup_date")
    days = period_summary_from(rollup, day, "pickup_date")
    return days.select(
        "pickup_date",
        calendar.year(day).alias("year"),
        calendar.month(day).alias("month"),
        calendar.day_of_week(day).alias("day_of_week"),
        *[c for c in days.columns if c != "pickup_date"],
    )


def daily_summary(fct: DataFrame, median_k: int = MEDIAN_K) -> DataFrame:
    return daily_summary_from(day_rollup(fct, median_k))


def monthly_summary_from(rollup: DataFrame) -> DataFrame:
    """The measures of the daily table per month (its first day): medians and numbers of zones of whole months."""
    return period_summary_from(rollup, calendar.month_start(F.col("pickup_date")), "month_start")


def yearly_summary_from(rollup: DataFrame) -> DataFrame:
    return period_summary_from(rollup, calendar.year(F.col("pickup_date")), "year")


# --- per hour and weekday, zone, distance band ------------------------------------------------------


def hour_rollup(fct: DataFrame) -> DataFrame:
    return clean_rollup(fct, "pickup_hour")


def hourly_patterns_from(rollup: DataFrame) -> DataFrame:
    """At most 168 rows: pickup hour by weekday."""
    dow = F.col("pickup_day_of_week")
    grouped = rollup.groupBy(
        "pickup_hour", calendar.day_of_week(F.col("pickup_date")).alias("pickup_day_of_week")
    ).agg(
        F.sum("trips").alias("total_trips"),
        _mean("distance").alias("avg_distance"),
        _mean("duration").alias("avg_duration"),
        _mean("amount").alias("avg_fare"),
        _mean("tip").alias("avg_tip"),
        _mean("speed").alias("avg_speed"),
    )
    return grouped.select(
        "pickup_hour",
        "pickup_day_of_week",
        labels.day_name(dow).alias("day_name"),
        labels.day_type(dow).alias("day_type"),
        "total_trips",
        "avg_distance",
        "avg_duration",
        "avg_fare",
        "avg_tip",
        "avg_speed",
    )


def hourly_patterns(fct: DataFrame) -> DataFrame:
    return hourly_patterns_from(hour_rollup(fct))


def zone_rollup(fct: DataFrame, *keys: str) -> DataFrame:
    """Trips and revenue per end and zone (and `keys`), from one pass over the fact.

    Each clean trip yields a pickup and a dropoff row inside the map task and both are combined there, so
    the shuffle carries two rows per zone and task.
    """
    ends = clean_trips(fct).select(
        *keys,
        "total_amount",
        F.explode(
            F.array(
                F.struct(F.lit(True).alias("is_pickup"), F.col("pickup_location_id").alias("location_id")),
                F.struct(F.lit(False).alias("is_pickup"), F.col("dropoff_location_id").alias("location_id")),
            )
        ).alias("trip_end"),
    )
    return ends.groupBy(*keys, "trip_end.is_pickup", "trip_end.location_id").agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("total_amount").alias("amount_sum"),
        F.count("total_amount").alias("amount_n"),
    )


def location_stats_from(rollup: DataFrame) -> DataFrame:
    """Per zone: trips by end, totals over both ends and a popularity rank.

    A trip counts once per end in the totals; `avg_fare` is the plain mean of the two ends' means.
    """
    per_end = rollup.groupBy("is_pickup", "location_id").agg(
        F.sum("trips").alias("trips"), F.sum("amount_sum").alias("revenue"), _mean("amount").alias("mean_fare")
    )
    per_zone = per_end.groupBy("location_id").agg(
        F.sum(F.when(F.col("is_pickup"), F.col("trips")).otherwise(0)).alias("pickup_trips"),
        F.sum(F.when(F.col("is_pickup"), 0).otherwise(F.col("trips"))).alias("dropoff_trips"),
        F.sum("trips").alias("total_trips"),
        F.sum("revenue").alias("total_revenue"),
        F.avg("mean_fare").alias("avg_fare"),
    )
    busiest_first = Window.orderBy(F.col("total_trips").desc())
    return per_zone.withColumn("popularity_rank", F.rank().over(busiest_first).cast("bigint"))


def location_stats(fct: DataFrame) -> DataFrame:
    return location_stats_from(zone_rollup(fct))


def band_rollup(fct: DataFrame) -> DataFrame:
    distance = F.col("trip_distance_miles")
    return clean_rollup(
        fct.filter(distance >= 0).withColumn("bucket_order", labels.bucket_order(distance)), "bucket_order"
    )


def trip_distance_distribution_from(rollup: DataFrame) -> DataFrame:
    """Six distance bands with their share of all clean trips."""
    grouped = rollup.groupBy("bucket_order").agg(
        F.sum("trips").alias("trip_count"),
        _mean("duration").alias("avg_duration_minutes"),
        _mean("amount").alias("avg_fare"),
        _mean("tip").alias("avg_tip"),
        F.sum("amount_sum").alias("total_revenue"),
    )
    all_bands = Window.partitionBy()
    names = [label for label, _ in fixed.DISTANCE_BANDS] + [fixed.DISTANCE_BAND_LAST]
    return grouped.select(
        labels.code_label(F.col("bucket_order"), dict(enumerate(names, start=1))).alias("distance_bucket"),
        "bucket_order",
        "trip_count",
        _percent(F.col("trip_count"), F.sum("trip_count").over(all_bands)).alias("pct_of_total"),
        "avg_duration_minutes",
        "avg_fare",
        "avg_tip",
        "total_revenue",
    )


def trip_distance_distribution(fct: DataFrame) -> DataFrame:
    return trip_distance_distribution_from(band_rollup(fct))


# --- monthly and yearly tables, all from one rollup by date, vendor and payment type -------------------

def _month_columns() -> list[Column]:
    first = F.col("month_start")
    return [
        calendar.year(first).alias("year"),
        calendar.month(first).alias("month"),
        calendar.year_month(first).alias("year_month"),
    ]


def monthly_trends_from(rollup: DataFrame) -> DataFrame:
    """Monthly volume, revenue and efficiency, with the previous present month alongside."""
    per_day = rollup.groupBy("pickup_date").agg(
        *[F.sum(c).alias(c) for c in rollup.columns if c == "trips" or c.endswith(("_sum", "_n"))]
    )
    monthly = per_day.groupBy(calendar.month_start(F.col("pickup_date")).alias("month_start")).agg(
        F.min("pickup_date").alias("month_start_date"),
        F.sum("trips").alias("total_trips"),
        F.sum("passengers_sum").alias("total_passengers"),
        (F.sum("trips") / F.count(F.lit(1))).alias("avg_daily_trips"),
        F.sum("amount_sum").alias("total_revenue"),
        F.sum("fare_sum").alias("fare_revenue"),
        F.sum("tip_sum").alias("tip_revenue"),
        (F.sum("amount_sum") / F.sum("trips")).alias("revenue_per_trip"),
        _mean("distance").alias("avg_distance"),
        _mean("duration").alias("avg_duration"),
        _mean("speed").alias("avg_speed"),
    )
    in_time = Window.orderBy("month_start")
    return monthly.select(
        *_month_columns(),
        "month_start_date",
        "total_trips",
        "total_passengers",
        "avg_daily_trips",
        "total_revenue",
        "fare_revenue",
        "tip_revenue",
        "revenue_per_trip",
        "avg_distance",
        "avg_duration",
        "avg_speed",
        F.lag("total_trips").over(in_time).alias("prev_month_trips"),
        F.lag("total_revenue").over(in_time).alias("prev_month_revenue"),
    )


def payment_analysis_from(rollup: DataFrame) -> DataFrame:
    """Month by payment type with the type's share of the month's trips."""
    grouped = rollup.groupBy(
        calendar.month_start(F.col("pickup_date")).alias("month_start"), "payment_type_id"
    ).agg(
        F.sum("trips").alias("trip_count"),
        F.sum("amount_sum").alias("total_revenue"),
        _mean("amount").alias("avg_fare"),
        _mean("tip").alias("avg_tip"),
        _mean("tip_pct").alias("avg_tip_pct"),
    )
    month_total = F.sum("trip_count").over(Window.partitionBy("month_start"))
    return grouped.select(
        *_month_columns(),
        "payment_type_id",
        labels.code_label(
            F.col("payment_type_id"), fixed.PAYMENT_GOLD_LABELS, fixed.PAYMENT_GOLD_DEFAULT
        ).alias("payment_type_name"),
        "trip_count",
        "total_revenue",
        "avg_fare",
        "avg_tip",
        "avg_tip_pct",
        _percent(F.col("trip_count"), month_total).alias("pct_of_monthly_trips"),
    )


def vendor_comparison_from(rollup: DataFrame) -> DataFrame:
    """Month by vendor with the vendor's share of the month's trips."""
    grouped = rollup.groupBy(
        calendar.month_start(F.col("pickup_date")).alias("month_start"), "vendor_id"
    ).agg(
        F.sum("trips").alias("trip_count"),
        F.sum("passengers_sum").alias("total_passengers"),
        F.sum("distance_sum").alias("total_distance"),
        F.sum("amount_sum").alias("total_revenue"),
        _mean("distance").alias("avg_distance"),
        _mean("duration").alias("avg_duration"),
        _mean("amount").alias("avg_fare"),
        _mean("tip").alias("avg_tip"),
    )
    month_total = F.sum("trip_count").over(Window.partitionBy("month_start"))
    return grouped.select(
        *_month_columns(),
        "vendor_id",
        labels.code_label(
            F.col("vendor_id"), fixed.VENDOR_GOLD_LABELS, fixed.VENDOR_GOLD_DEFAULT
        ).alias("vendor_name"),
        "trip_count",
        "total_passengers",
        "total_distance",
        "total_revenue",
        "avg_distance",
        "avg_duration",
        "avg_fare",
        "avg_tip",
        _percent(F.col("trip_count"), month_total).alias("market_share_pct"),
    )


def year_over_year_from(rollup: DataFrame) -> DataFrame:
    """Yearly totals and their change against the previous present year."""
    yearly = rollup.groupBy(calendar.year(F.col("pickup_date")).alias("year")).agg(
        F.sum("trips").alias("total_trips"),
        F.sum("amount_sum").alias("total_revenue"),
        F.sum("tip_sum").alias("total_tips"),
        _mean("distance").alias("avg_distance"),
        _mean("duration").alias("avg_duration"),
        _mean("amount").alias("avg_fare"),
    )
    in_time = Window.orderBy("year")
    with_previous = yearly.withColumns(
        {
            "prev_year_trips": F.lag("total_trips").over(in_time),
            "prev_year_revenue": F.lag("total_revenue").over(in_time),
        }
    )

    def change(now: str, before: str) -> Column:
        return _percent(F.col(now) - F.col(before), F.nullif(F.col(before), F.lit(0)))

    return with_previous.withColumns(
        {
            "trips_yoy_change_pct": change("total_trips", "prev_year_trips"),
            "revenue_yoy_change_pct": change("total_revenue", "prev_year_revenue"),
        }
    )


def monthly_trends(fct: DataFrame) -> DataFrame:
    return monthly_trends_from(clean_rollup(fct))


def payment_analysis(fct: DataFrame) -> DataFrame:
    return payment_analysis_from(clean_rollup(fct, "payment_type_id"))


def vendor_comparison(fct: DataFrame) -> DataFrame:
    return vendor_comparison_from(clean_rollup(fct, "vendor_id"))


def year_over_year(fct: DataFrame) -> DataFrame:
    return year_over_year_from(clean_rollup(fct))
