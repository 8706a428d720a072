"""The registered queries: every operator run over the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelake import schemas
from farelake.functions import fixed, labels, trips
from farelake.functions.sizing import broadcast_if_small
from farelake.operators import dims, dq, fact, gold, merge, models, readlayer, reshape, runs, series, staging
from farelake.plans import forecast as forecasting
from farelake.plans import gold as gold_plan
from farelake.plans import load
from farelake.session import configure, scratch_path
from farelake.sources import bronze, fx, tables
from farelake.sources import zones as zone_files
from farelake.streaming import trips as streaming
from harness.fixture import raw_trips, table

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    _REGISTRY[fn.__name__] = run
    return fn


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_trips(raw_trips(spark, sf_dir))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact.fct_trips(staged(spark, sf_dir))


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Means of values that are not binary fractions depend on summation order in the last digits."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- staging, derived columns, fact ----------------------------------------------------------------


@query
def stg_trips(spark, sf_dir):
    return staged(spark, sf_dir).drop("_loaded_at")


@query
def trip_id(spark, sf_dir):
    return facts(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("trips"),
        F.countDistinct("trip_id").alias("distinct_ids"),
        F.count_if(F.col("trip_id").isNull()).alias("missing_ids"),
    )


@query
def trip_dates(spark, sf_dir):
    return staged(spark, sf_dir).select(
        "pickup_datetime",
        F.to_date("pickup_datetime").alias("pickup_date"),
        F.to_date("dropoff_datetime").alias("dropoff_date"),
        F.hour("pickup_datetime").cast("bigint").alias("pickup_hour"),
        F.hour("dropoff_datetime").cast("bigint").alias("dropoff_hour"),
        F.dayofweek("pickup_datetime").cast("bigint").alias("pickup_day_of_week"),
    )


@query
def trip_duration(spark, sf_dir):
    return staged(spark, sf_dir).select(
        "pickup_datetime", "dropoff_datetime", trips.duration_minutes().alias("trip_duration_minutes")
    )


@query
def avg_speed_mph(spark, sf_dir):
    return staged(spark, sf_dir).select(
        "pickup_datetime", "trip_distance_miles", trips.speed_mph().alias("avg_speed_mph")
    )


@query
def tip_percentage(spark, sf_dir):
    return staged(spark, sf_dir).select(
        "pickup_datetime", "fare_amount", trips.tip_percentage().alias("tip_percentage")
    )


@query
def quality_flag(spark, sf_dir):
    return (
        staged(spark, sf_dir)
        .groupBy(
            trips.quality_issue().alias("has_data_quality_issue"),
            (F.col("trip_distance_miles") <= 0).alias("bad_distance"),
        )
        .agg(F.count(F.lit(1)).alias("trips"), F.sum("total_amount").alias("total_amount"))
    )


@query
def valid_trips(spark, sf_dir):
    return fact.valid_trips(staged(spark, sf_dir)).drop("_loaded_at")


@query
def fct_trips(spark, sf_dir):
    return facts(spark, sf_dir).drop("trip_id", "_loaded_at")


# --- dimensions -------------------------------------------------------------------------------------


@query
def dim_vendor(spark, sf_dir):
    return dims.dim_vendor(staged(spark, sf_dir))


@query
def dim_payment_type(spark, sf_dir):
    return dims.dim_payment_type(staged(spark, sf_dir))


@query
def dim_rate_code(spark, sf_dir):
    return dims.dim_rate_code(staged(spark, sf_dir))


@query
def dim_date(spark, sf_dir):
    return dims.dim_date_of(facts(spark, sf_dir))


@query
def dim_date_stored(spark, sf_dir):
    """The calendar as stored, from its first day to its last, with the trips of each day in other years beside it."""
    path = scratch_path(spark, "dim-date")
    stored = tables.replace_table(dims.dim_date(spark), path, schemas.DIM_DATE)
    same_day = facts(spark, sf_dir).groupBy(F.date_format("pickup_date", "MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("trips"))
    joined = stored.withColumn("day", F.date_format("date_key", "MM-dd")).join(broadcast_if_small(same_day), "day", "left")
    return joined.drop("day")


@query
def dim_time(spark, sf_dir):
    per_hour = (
        facts(spark, sf_dir)
        .groupBy(F.col("pickup_hour").alias("hour_key"))
        .agg(F.count(F.lit(1)).alias("trips"))
    )
    hours = dims.dim_time(spark).join(per_hour, "hour_key", "left")
    return hours.withColumn("trips", F.coalesce("trips", F.lit(0)))


@query
def day_labels(spark, sf_dir):
    per_day = facts(spark, sf_dir).groupBy("pickup_date").agg(F.count(F.lit(1)).alias("trips"))
    dow = F.dayofweek("pickup_date")
    return per_day.select(
        "pickup_date", labels.day_name(dow).alias("day_name"), labels.day_type(dow).alias("day_type"), "trips"
    )


@query
def distance_bucket(spark, sf_dir):
    per_distance = (
        staged(spark, sf_dir).groupBy("trip_distance_miles").agg(F.count(F.lit(1)).alias("trips"))
    )
    return per_distance.withColumn("distance_bucket", labels.distance_bucket(F.col("trip_distance_miles")))


# --- gold -------------------------------------------------------------------------------------------


def daily(spark, sf_dir):
    return rounded(gold.daily_summary(facts(spark, sf_dir)), "avg_tip_percentage")


@query
def daily_summary(spark, sf_dir):
    return daily(spark, sf_dir)


@query
def monthly_summary(spark, sf_dir):
    """Medians and numbers of zones of whole months, finished from a stored rollup by day."""
    path = scratch_path(spark, "by-day")
    gold.day_rollup(facts(spark, sf_dir)).write.parquet(path)
    return rounded(gold.monthly_summary_from(spark.read.parquet(path)), "avg_tip_percentage")


@query
def yearly_summary(spark, sf_dir):
    """The same by year; medians of so many trips are approximate, so they are tested elsewhere."""
    path = scratch_path(spark, "by-day")
    gold.day_rollup(facts(spark, sf_dir)).write.parquet(path)
    years = gold.yearly_summary_from(spark.read.parquet(path)).drop("median_distance_miles", "median_duration_minutes")
    return rounded(years, "avg_tip_percentage", "avg_distance_miles", "avg_duration_minutes", "avg_trip_revenue", "avg_tip")


@query
def hourly_patterns(spark, sf_dir):
    return rounded(gold.hourly_patterns(facts(spark, sf_dir)), "avg_speed")


@query
def monthly_trends(spark, sf_dir):
    return rounded(gold.monthly_trends(facts(spark, sf_dir)), "avg_speed")


@query
def location_stats(spark, sf_dir):
    return gold.location_stats(facts(spark, sf_dir))


@query
def payment_analysis(spark, sf_dir):
    return rounded(gold.payment_analysis(facts(spark, sf_dir)), "avg_tip_pct")


@query
def trip_distance_distribution(spark, sf_dir):
    return gold.trip_distance_distribution(facts(spark, sf_dir))


@query
def vendor_comparison(spark, sf_dir):
    return gold.vendor_comparison(facts(spark, sf_dir))


@query
def year_over_year(spark, sf_dir):
    return gold.year_over_year(facts(spark, sf_dir))


# --- star join, zones ---------------------------------------------------------------------------------


def stored_code_dimensions(spark, sf_dir):
    """The code dimensions as tables, whose size the planner knows."""
    stg, path = staged(spark, sf_dir), scratch_path(spark, "dims")
    made = (
        (dims.dim_vendor(stg), schemas.DIM_VENDOR),
        (dims.dim_payment_type(stg), schemas.DIM_PAYMENT_TYPE),
        (dims.dim_rate_code(stg), schemas.DIM_RATE_CODE),
    )
    return [tables.replace_table(df, f"{path}/{i}", schema) for i, (df, schema) in enumerate(made)]


@query
def star_trips(spark, sf_dir):
    fct = facts(spark, sf_dir)
    joined = dims.star_trips(
        fct,
        *map(broadcast_if_small, stored_code_dimensions(spark, sf_dir)),
        F.broadcast(dims.dim_date(spark, "1990-01-01", "2030-12-31")),  # one row per day of 41 years
        F.broadcast(dims.dim_time(spark)),  # 24 rows
    )
    return joined.groupBy(
        "vendor_name", "payment_type_name", "rate_code_name", "pickup_day_name", "pickup_fiscal_year",
        "pickup_is_weekend", "time_period", "is_rush_hour", "peak_category",
    ).agg(F.count(F.lit(1)).alias("trips"), F.sum("total_amount").alias("total_amount"))


def zones(spark, sf_dir):
    """Names for the zones that the supplier table knows, by nature not all of 263; some have no borough."""
    zone_id = (F.col("s_suppkey") * 7 % 263 + 1).alias("location_id")
    named = table(spark, sf_dir, "supplier").groupBy(zone_id).agg(
        F.min("s_name").alias("zone"), F.concat(F.lit("nation "), F.min("s_nationkey").cast("string")).alias("borough")
    )
    return named.withColumn("borough", F.when(F.col("location_id") % 10 != 0, F.col("borough")))


@query
def zone_lookup(spark, sf_dir):
    per_zone = facts(spark, sf_dir).groupBy(F.col("pickup_location_id").alias("location_id")).agg(
        F.count(F.lit(1)).alias("trips")
    )
    return reshape.zone_lookup(per_zone, zones(spark, sf_dir))


# --- data quality -------------------------------------------------------------------------------------


@query
def dq_not_null(spark, sf_dir):
    stg = staged(spark, sf_dir).drop("_loaded_at")
    return dq.dq_not_null(stg, stg.columns)


@query
def dq_unique(spark, sf_dir):
    stg = staged(spark, sf_dir)
    found = [dq.dq_unique(stg, c) for c in ("pickup_datetime", "pickup_location_id", "vendor_id")]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query
def dq_report(spark, sf_dir):
    stg = staged(spark, sf_dir)
    fct = fact.fct_trips(stg)
    return dq.dq_report(
        {
            "dim_vendor": dims.dim_vendor(stg),
            "dim_payment_type": dims.dim_payment_type(stg),
            "dim_rate_code": dims.dim_rate_code(stg),
            "dim_date": dims.dim_date_of(fct),
            "dim_time": dims.dim_time(spark),
            "fct_trips": fct,
        }
    )


# --- read layer ---------------------------------------------------------------------------------------

#: The fixture has 7 to 38 trips a day at the checked scale, far below the default threshold of 100.
MIN_TRIPS = 10


def gold_daily(spark, sf_dir):
    return gold.daily_summary(facts(spark, sf_dir))


def last_valid(spark, sf_dir):
    return readlayer.last_valid_date(gold_daily(spark, sf_dir), min_trips=MIN_TRIPS)


@query
def last_valid_date(spark, sf_dir):
    return last_valid(spark, sf_dir)


@query
def last_valid_month(spark, sf_dir):
    return readlayer.last_valid_month(last_valid(spark, sf_dir))


@query
def kpi_summary(spark, sf_dir):
    kpis = readlayer.kpi_summary(gold_daily(spark, sf_dir), last_valid(spark, sf_dir))
    return rounded(kpis, "avg_fare", "avg_tip")


def monthly_read(spark, sf_dir):
    return readlayer.monthly_trends_view(gold.monthly_trends(facts(spark, sf_dir)), last_valid(spark, sf_dir))


def daily_read(spark, sf_dir, days=365):
    return readlayer.daily_view(
        gold_daily(spark, sf_dir), last_valid(spark, sf_dir), days=days, min_trips=MIN_TRIPS
    )


def hourly_read(spark, sf_dir):
    return readlayer.hourly_view(gold.hourly_patterns(facts(spark, sf_dir)))


def payment_read(spark, sf_dir):
    return readlayer.payment_view(gold.payment_analysis(facts(spark, sf_dir)), last_valid(spark, sf_dir))


def vendor_read(spark, sf_dir):
    return readlayer.vendor_view(gold.vendor_comparison(facts(spark, sf_dir)), last_valid(spark, sf_dir))


def location_read(spark, sf_dir, limit=None):
    return readlayer.location_view(gold.location_stats(facts(spark, sf_dir)), limit)


def yoy_read(spark, sf_dir):
    return readlayer.yoy_view(gold.year_over_year(facts(spark, sf_dir)), last_valid(spark, sf_dir))


@query
def monthly_trends_view(spark, sf_dir):
    return monthly_read(spark, sf_dir)


@query
def daily_view(spark, sf_dir):
    return daily_read(spark, sf_dir)


@query
def hourly_view(spark, sf_dir):
    return rounded(hourly_read(spark, sf_dir), "avg_speed")


@query
def payment_view(spark, sf_dir):
    return rounded(payment_read(spark, sf_dir), "avg_tip_pct")


@query
def distance_view(spark, sf_dir):
    return readlayer.distance_view(gold.trip_distance_distribution(facts(spark, sf_dir)))


@query
def location_view(spark, sf_dir):
    return location_read(spark, sf_dir, fixed.ZONES_SHOWN)


@query
def vendor_view(spark, sf_dir):
    return vendor_read(spark, sf_dir)


@query
def yoy_view(spark, sf_dir):
    return yoy_read(spark, sf_dir)


# --- chart frames -------------------------------------------------------------------------------------


@query
def heatmap_matrix(spark, sf_dir):
    return reshape.heatmap_matrix(hourly_read(spark, sf_dir))


@query
def payment_latest(spark, sf_dir):
    return rounded(reshape.payment_latest(payment_read(spark, sf_dir)), "avg_tip_pct")


@query
def vendor_series(spark, sf_dir):
    return reshape.vendor_series(vendor_read(spark, sf_dir))


@query
def tip_last_12(spark, sf_dir):
    return rounded(reshape.tip_last_12(payment_read(spark, sf_dir)), "avg_tip", "avg_tip_pct")


@query
def top_zones(spark, sf_dir):
    return reshape.top_zones(location_read(spark, sf_dir))


@query
def zone_activity(spark, sf_dir):
    return reshape.zone_activity(location_read(spark, sf_dir), zones(spark, sf_dir))


@query
def monthly_series(spark, sf_dir):
    return reshape.monthly_series(monthly_read(spark, sf_dir)).select("year_month", "total_trips", "avg_fare")


@query
def daily_series(spark, sf_dir):
    return reshape.daily_series(daily_read(spark, sf_dir)).select("pickup_date", "total_trips", "total_revenue")


@query
def yoy_series(spark, sf_dir):
    return reshape.yoy_series(yoy_read(spark, sf_dir))


@query
def compact_number(spark, sf_dir):
    yearly = gold.year_over_year(facts(spark, sf_dir))
    return yearly.select(
        "year",
        labels.compact_number(F.col("total_trips"), 1).alias("trips"),
        labels.compact_number(F.col("total_revenue")).alias("revenue"),
        labels.compact_number(F.col("avg_fare"), 2).alias("avg_fare"),
    )


# --- daily series -------------------------------------------------------------------------------------

AS_OF = dt.date(2001, 6, 30)


def training(spark, sf_dir, years=2):
    return series.training_frame(gold_daily(spark, sf_dir), "total_trips", years, AS_OF)


@query
def training_frame(spark, sf_dir):
    return training(spark, sf_dir)


@query
def time_features(spark, sf_dir):
    days = training(spark, sf_dir, years=10).select("ds", "y")
    waves = rounded(series.time_features(days), "month_sin", "month_cos", "day_sin", "day_cos")
    return waves.select(
        "ds", "y", *[F.col(c).cast("bigint").alias(c) for c in series.TIME_FEATURES[:10]],
        *[(F.col(c) + F.lit(0.0)).alias(c) for c in series.TIME_FEATURES[10:]],
    )


@query
def holdout_split(spark, sf_dir):
    return series.holdout_split(training(spark, sf_dir).select("ds", "y"), 30)


@query
def future_dates(spark, sf_dir):
    return series.future_dates(training(spark, sf_dir), 30)


def last_week_as_forecast(spark, sf_dir):
    """A forecast the SQL side can state: each day repeats the value of seven rows before."""
    a_week_before = F.lag("y", 7).over(Window.orderBy("ds"))
    days = training(spark, sf_dir, years=10).select("ds", "y")
    return days.select("ds", a_week_before.alias("forecast")).filter(F.col("forecast").isNotNull())


def validated(spark, sf_dir):
    held_out = series.holdout_split(training(spark, sf_dir, years=10).select("ds", "y"), 365)
    return series.validation_frame(held_out.filter("is_validation"), last_week_as_forecast(spark, sf_dir))


@query
def validation_frame(spark, sf_dir):
    return validated(spark, sf_dir)


@query
def forecast_metrics(spark, sf_dir):
    return rounded(series.forecast_metrics(validated(spark, sf_dir)), "mae", "rmse", "mape")


@query
def log_run(spark, sf_dir):
    """The last-week forecast logged as a run and read back from the run table."""
    path = scratch_path(spark, "ml-runs")
    stored = scratch_path(spark, "validation")
    validated(spark, sf_dir).write.parquet(stored)
    validation = spark.read.parquet(stored)
    scores = series.forecast_metrics(validation).first()
    span = validation.agg(F.min("ds").alias("first"), F.max("ds").alias("last"), F.count("ds").alias("days")).first()
    runs.log_run(
        spark, path, "0123456789abcdef", runs.run_name("last_week", "total_trips", span["last"]), "FINISHED",
        dt.datetime(2001, 7, 1), {"model_type": "last_week", "target_metric": "total_trips",
        "forecast_horizon_days": span["days"]}, scores.asDict(),
    )
    return rounded(runs.recent_runs(spark.read.parquet(path)).drop("start_time"), "mae", "rmse", "mape")


@query
def accuracy_points(spark, sf_dir):
    return reshape.accuracy_points(validated(spark, sf_dir))


@query
def future_frame(spark, sf_dir):
    return series.future_frame(last_week_as_forecast(spark, sf_dir))


@query
def future_summary(spark, sf_dir):
    ahead = series.future_frame(last_week_as_forecast(spark, sf_dir))
    return rounded(series.future_summary(ahead), "mean_forecast")


@query
def forecast_band(spark, sf_dir):
    return rounded(reshape.forecast_band(series.future_frame(last_week_as_forecast(spark, sf_dir))), "lower", "upper")


# --- run table ----------------------------------------------------------------------------------------


def run_table(spark, sf_dir):
    """One run per order: every status, nameless runs, missing parameters and missing errors occur."""
    key = F.col("o_orderkey")
    model = F.element_at(
        F.array(*[F.lit(m) for m in ("additive", "sarma", "gbt", "holtwinters")]), (key % 4 + 1).cast("int")
    )
    metric = F.element_at(F.array(*[F.lit(m) for m in fixed.TARGET_METRICS]), (key % 3 + 1).cast("int"))
    mape = (key * 37 % 1000).cast("double") / 16
    params = F.map_from_arrays(
        F.array(F.lit("model_type"), F.lit("target_metric"), F.lit("forecast_horizon_days")),
        F.array(model, metric, (key % 30 + 7).cast("string")),
    )
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("run-"), F.lpad(key.cast("string"), 12, "0")).alias("run_id"),
        F.when(key % 5 != 0, F.concat_ws("_", model, metric)).alias("run_name"),
        F.when(F.col("o_orderstatus") == "F", "FINISHED")
        .when(F.col("o_orderstatus") == "O", "RUNNING")
        .otherwise("FAILED")
        .alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("start_time"),
        F.when(key % 11 != 0, params).otherwise(F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))).alias("params"),
        F.when(
            key % 7 != 0,
            F.map_from_arrays(
                F.array(F.lit("mae"), F.lit("rmse"), F.lit("mape")), F.array(mape * 4, mape * 8, mape)
            ),
        ).otherwise(F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))).alias("metrics"),
    )


@query
def recent_runs(spark, sf_dir):
    return runs.recent_runs(run_table(spark, sf_dir), 20)


@query
def best_run(spark, sf_dir):
    return runs.best_run(run_table(spark, sf_dir), "total_revenue")


@query
def model_comparison(spark, sf_dir):
    return runs.model_comparison(run_table(spark, sf_dir))


@query
def mape_grade(spark, sf_dir):
    flat = runs.flatten_runs(run_table(spark, sf_dir))
    return flat.groupBy(labels.mape_grade(F.col("mape")).alias("grade")).agg(F.count(F.lit(1)).alias("runs"))


@query
def best_per_model(spark, sf_dir):
    return reshape.best_per_model(
        runs.flatten_runs(run_table(spark, sf_dir)).drop("run_name", "status", "forecast_horizon"), by_metric=True
    )


@query
def best_per_model_overall(spark, sf_dir):
    return reshape.best_per_model(runs.model_comparison(run_table(spark, sf_dir), limit=None))


@query
def graded_runs(spark, sf_dir):
    return runs.graded_runs(run_table(spark, sf_dir), limit=None)


@query
def runs_history(spark, sf_dir):
    return reshape.runs_history(runs.flatten_runs(run_table(spark, sf_dir)))


@query
def forecast_with_history(spark, sf_dir):
    all_runs = run_table(spark, sf_dir)
    # Artifacts of every run: as many validation and forecast rows as the run's order has lines.
    lines = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("run-"), F.lpad(F.col("l_orderkey").cast("string"), 12, "0")).alias("run_id"),
        F.to_date("l_shipdate").alias("ds"),
        F.col("l_quantity").alias("y_true"),
        (F.col("l_quantity") + 2).alias("y_pred"),
    )
    ahead = lines.select("run_id", F.date_add("ds", 30).alias("date"), F.col("y_pred").alias("forecast"))
    return runs.forecast_with_history(all_runs, lines, ahead, daily_read(spark, sf_dir, days=90), "total_trips")


# --- bronze lake ----------------------------------------------------------------------------------------


def monthly_raw(spark, sf_dir):
    """Raw trips with the month of the file they would arrive in."""
    pickup = F.col("tpep_pickup_datetime")
    return raw_trips(spark, sf_dir).withColumns(
        {"year": F.year(pickup), "month": F.date_format(pickup, "MM")}
    )


def landed(spark, sf_dir):
    root = scratch_path(spark, "bronze")
    bronze.bronze_land_months(monthly_raw(spark, sf_dir), root)
    return root


def month_totals(trips_by_file):
    return trips_by_file.groupBy(F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month")).agg(
        F.count(F.lit(1)).alias("trips"), F.sum("fare_amount").alias("fares")
    )


@query
def bronze_land_months(spark, sf_dir):
    return month_totals(spark.read.parquet(landed(spark, sf_dir)))


@query
def bronze_land(spark, sf_dir):
    """An inbox of files that differ in columns and types, landed as one month and read back."""
    inbox, root = scratch_path(spark, "inbox"), scratch_path(spark, "bronze")
    raw = raw_trips(spark, sf_dir)
    older, feeless = F.year("tpep_pickup_datetime") < 1999, F.col("Airport_fee").isNull()
    raw.filter(older & ~feeless).withColumn("passenger_count", F.col("passenger_count").cast("double")).write.parquet(f"{inbox}/a")
    raw.filter(older & feeless).drop("Airport_fee").write.parquet(f"{inbox}/b")
    raw.filter(~older).write.parquet(f"{inbox}/c")
    bronze.bronze_land(spark, inbox, root, 1999, 1)
    read = bronze.bronze_scan(spark, root).drop("year", "month")
    return read.withColumn("passenger_count", F.col("passenger_count").cast("bigint"))


def drifted(spark, sf_dir):
    """A lake whose files changed types over the years: counts as doubles, a column in lower case."""
    root = scratch_path(spark, "bronze")
    raw = monthly_raw(spark, sf_dir)
    eras = (
        raw.filter(F.col("year") < 1998),
        raw.filter(F.col("year").between(1998, 1999)).withColumn("passenger_count", F.col("passenger_count").cast("double")),
        raw.filter(F.col("year") >= 2000).withColumnRenamed("Airport_fee", "airport_fee"),
    )
    for era in eras:
        bronze.bronze_land_months(era, root)
    return root


@query
def bronze_scan(spark, sf_dir):
    trips_read = bronze.bronze_scan(spark, drifted(spark, sf_dir))
    years = staging.stg_trips(trips_read).groupBy(F.year("pickup_datetime").cast("bigint").alias("year"))
    return years.agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("passenger_count").alias("passengers"),
        F.sum("airport_fee").alias("airport_fees"),
    )


@query
def bronze_validate(spark, sf_dir):
    checked = bronze.bronze_validate(spark, landed(spark, sf_dir), expected=[(1996, 1), (2001, 1)])
    return checked.groupBy("year", "month").agg(
        F.sum("num_rows").alias("num_rows"), F.max("num_columns").alias("num_columns")
    )


@query
def bronze_metrics(spark, sf_dir):
    log = scratch_path(spark, "load-log")
    bronze.log_load(bronze.bronze_validate(spark, landed(spark, sf_dir)), log)
    return spark.read.parquet(log).select(
        "year", "month", "num_rows", "num_columns", (F.col("file_size_mb") > 0).alias("has_size")
    )


# --- stored tables --------------------------------------------------------------------------------------


@query
def replace_table(spark, sf_dir):
    """Stored once, then replaced by a table computed from its own rows."""
    path = scratch_path(spark, "vendor")
    stored = tables.replace_table(gold.vendor_comparison(facts(spark, sf_dir)), path, schemas.VENDOR_COMPARISON)
    return tables.replace_table(stored.filter(F.col("vendor_name") != "Unknown"), path, schemas.VENDOR_COMPARISON)


@query
def staging_view(spark, sf_dir):
    tables.replace_view(staged(spark, sf_dir), "stg_trips")
    return spark.sql(
        "SELECT payment_type_id, count(*) AS trips, sum(tip_amount) AS tips FROM stg_trips GROUP BY payment_type_id"
    )


@query
def partition_cluster(spark, sf_dir):
    path = scratch_path(spark, "fact")
    tables.write_clustered(fact.with_month(facts(spark, sf_dir)), path)
    return spark.read.parquet(path).drop("trip_id", "_loaded_at")


@query
def incremental_filter(spark, sf_dir):
    stg = staged(spark, sf_dir)
    loaded = fact.fct_trips(stg).filter(F.col("pickup_date") < "2000-01-01")
    return fact.incremental_filter(stg, loaded).drop("_loaded_at")


@query
def merge_trips(spark, sf_dir):
    """Trips until 1999 are stored; then the trips since July 1999 arrive, half of them corrections."""
    path = scratch_path(spark, "fact")
    fct = fact.with_month(facts(spark, sf_dir))
    arriving = fct.filter(F.col("pickup_date") >= "1999-07-01").withColumn("tip_amount", F.col("tip_amount") + 1)
    for batch in (fct.filter(F.col("pickup_date") < "2000-01-01"), arriving):
        merge.merge_partitioned(spark, path, batch, ["trip_id"], fact.MONTH_COLUMN)
    return spark.read.parquet(path).drop("trip_id", "_loaded_at", "pickup_month")


@query
def stream_trips(spark, sf_dir):
    """The lake whose files changed types over the years, as a stream."""
    lake, checkpoint = scratch_path(spark, "lake"), scratch_path(spark, "stream")
    streaming.stream_trips(spark, drifted(spark, sf_dir), lake, checkpoint).awaitTermination()
    return load.read_fact(spark, lake).drop("trip_id", "_loaded_at", "pickup_month", *fixed.SOURCE_COLUMNS)


@query
def stream_then_load(spark, sf_dir):
    """The years before 1998 are streamed, the rest is loaded in a batch, and gold takes in what both noted as changed."""
    root, lake, checkpoint = scratch_path(spark, "bronze"), scratch_path(spark, "lake"), scratch_path(spark, "stream")
    raw = monthly_raw(spark, sf_dir)
    bronze.bronze_land_months(raw.filter("year < 1998"), root)
    streaming.stream_trips(spark, root, lake, checkpoint).awaitTermination()
    gold_plan.build_gold(spark, lake, months="pending")
    bronze.bronze_land_months(raw.filter("year >= 1998"), root)
    load.load_fact(spark, root, lake)
    gold_plan.build_gold(spark, lake, months="pending")
    return rounded(gold_plan.read_gold(spark, lake)["daily_summary"], "avg_tip_percentage")


@query
def load_after_crash(spark, sf_dir):
    """Years until 1998 are loaded; of the next load only its newest month gets committed, then the driver dies."""
    root, lake = scratch_path(spark, "bronze"), scratch_path(spark, "lake")
    raw = monthly_raw(spark, sf_dir)
    bronze.bronze_land_months(raw.filter(F.col("year") < 1999), root)
    load.load_fact(spark, root, lake)
    bronze.bronze_land_months(raw.filter(F.col("year") >= 1999), root)
    fct = fact.with_month(facts(spark, sf_dir))
    newest = fct.agg(F.max("pickup_month")).first()[0]
    merge.merge_partitioned(spark, load.fact_path(lake), fct.filter(F.col("pickup_month") == F.lit(newest)), ["trip_id"], fact.MONTH_COLUMN)
    load.load_fact(spark, root, lake)
    return load.read_fact(spark, lake).drop("trip_id", "_loaded_at", "pickup_month", *fixed.SOURCE_COLUMNS)


@query
def gold_rebuild(spark, sf_dir):
    """Gold of the whole fact; then a year leaves the fact and everything is built again."""
    lake = scratch_path(spark, "lake")
    fct = fact.with_month(facts(spark, sf_dir))
    tables.write_clustered(fct, load.fact_path(lake))
    gold_plan.build_gold(spark, lake)
    tables.write_clustered(fct.filter(F.year("pickup_date") != 1998), load.fact_path(lake), whole=True)
    gold_plan.build_gold(spark, lake)
    return rounded(gold_plan.read_gold(spark, lake)["daily_summary"], "avg_tip_percentage")


@query
def csv_source(spark, sf_dir):
    path = scratch_path(spark, "training-csv")
    tables.csv_sink(training(spark, sf_dir, years=10), path)
    return tables.csv_source(spark, path, schemas.TRAINING)


@query
def json_records(spark, sf_dir):
    per_zone = facts(spark, sf_dir).groupBy("pickup_location_id", "vendor_id").agg(F.count(F.lit(1)).alias("trips"))
    return tables.json_records(per_zone)


@query
def zone_source(spark, sf_dir):
    """Zones written out as one GeoJSON document and read back; at most 263 features by construction."""
    path = scratch_path(spark, "zones-geojson")
    properties = F.struct(F.col("location_id").alias("LocationID"), "zone", "borough")
    feature = F.struct(F.lit("Feature").alias("type"), properties.alias("properties"))
    nameless = F.array(F.struct(F.lit("Feature").alias("type"), F.struct(
        F.lit(None).cast("bigint").alias("LocationID"), F.lit("nowhere").alias("zone"), F.lit(None).cast("string").alias("borough")
    ).alias("properties")))
    document = zones(spark, sf_dir).agg(F.concat(F.collect_list(feature), nameless).alias("features"))
    collection = F.struct(F.lit("FeatureCollection").alias("type"), "features")
    document.select(F.to_json(collection, {"pretty": "true"}).alias("value")).write.text(path)
    return zone_files.zone_source(spark, path)


# --- exchange rates -------------------------------------------------------------------------------------


def order_rates(spark, sf_dir):
    """One rate per order date and 25 quote currencies, in eighths."""
    quote = F.concat(F.lit("C"), F.lpad((F.col("o_custkey") % 25).cast("string"), 2, "0"))
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.to_date("o_orderdate").alias("feed_date"), quote.alias("quote"))
        .agg(((F.sum(F.col("o_orderkey") % 1000) + 1) / F.lit(8.0)).cast("decimal(18,6)").alias("rate"))
    )


@query
def fx_extract(spark, sf_dir):
    path = scratch_path(spark, "fx-xml")
    cube = F.struct(F.col("quote").alias("_currency"), F.col("rate").alias("_rate"))
    days = order_rates(spark, sf_dir).groupBy("feed_date").agg(F.collect_list(cube).alias("Cube"))  # <= 25 each
    day = F.struct(F.col("feed_date").cast("string").alias("_time"), "Cube")
    years = days.groupBy(F.year("feed_date")).agg(F.collect_list(day).alias("Cube"))  # an envelope of <= 366 days
    feed = years.select(F.struct("Cube").alias("Cube"))
    feed.write.format("xml").option("rowTag", "Envelope").option("rootTag", "feeds").save(path)
    rates = fx.fx_extract(spark, path, row_tag="Envelope")
    return rates.withColumn("rate", F.col("rate").cast("double"))


@query
def fx_records(spark, sf_dir):
    record = F.struct(F.lit("EUR").alias("base"), "quote", F.col("rate").cast("string").alias("rate"))
    days = order_rates(spark, sf_dir).groupBy("feed_date").agg(F.to_json(F.collect_list(record)).alias("records"))
    return fx.fx_records(days, "records").withColumn("rate", F.col("rate").cast("double"))


@query
def fx_upsert(spark, sf_dir):
    """Rates before 2000 are stored; a later run brings those since 1998 again, doubled, plus new dates."""
    rates = order_rates(spark, sf_dir).withColumn("base", F.lit("EUR"))
    run_date = F.col("feed_date")
    stored = fx.as_rows(rates.filter(run_date < "2000-01-01"), run_date)
    arriving = rates.filter(run_date >= "1998-01-01").withColumns({"rate": F.col("rate") * 2, "base": F.lit("USD")})
    merged = fx.fx_upsert(stored, arriving, run_date)
    return merged.withColumn("rate", F.col("rate").cast("double"))


@query
def fx_table(spark, sf_dir):
    """Each month's highest rates are stored twice, the second time doubled for half of the currencies."""
    path = scratch_path(spark, "fx-rates")
    fx.fx_table(spark, path)
    month = F.trunc("feed_date", "MM").alias("feed_date")
    rates = order_rates(spark, sf_dir).groupBy("quote", month).agg(F.max("rate").alias("rate")).withColumn("base", F.lit("EUR"))
    fx.fx_load(spark, path, rates, F.col("feed_date"))
    half = rates.filter(F.col("quote") < "C12").withColumn("rate", F.col("rate") * 2)
    fx.fx_load(spark, path, half, F.col("feed_date"))
    return fx.fx_table(spark, path).withColumn("rate", F.col("rate").cast("double"))


# --- forecast models --------------------------------------------------------------------------------------


def stored_training(spark, sf_dir):
    """The two-year training frame, written once: fitting reads it many times."""
    path = scratch_path(spark, "training")
    training(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path).select("ds", "y")


@query
def forecast_additive_trips(spark, sf_dir):
    return models.forecast_additive(stored_training(spark, sf_dir), 30)


@query
def forecast_sarma_trips(spark, sf_dir):
    """Every zone's trips; a zone too short for the model has NULL and a note."""
    return models.forecast_sarma(zone_series(spark, sf_dir), 30, key="zone")


@query
def forecast_holtwinters_trips(spark, sf_dir):
    return models.forecast_holtwinters(zone_series(spark, sf_dir), 30, key="zone")


@query
def forecast_gbt_trips(spark, sf_dir):
    return models.forecast_gbt(stored_training(spark, sf_dir), 30)


def zone_series(spark, sf_dir):
    per_day = facts(spark, sf_dir).groupBy(F.col("pickup_location_id").alias("zone"), F.col("pickup_date").alias("ds"))
    return series.fill_days(per_day.agg(F.count(F.lit(1)).cast("double").alias("y")), "zone")


@query
def fill_days(spark, sf_dir):
    return zone_series(spark, sf_dir).groupBy("zone").agg(
        F.count(F.lit(1)).alias("days"), F.sum("y").alias("trips"), F.count_if(F.col("y") == 0).alias("empty_days")
    )


@query
def forecast_job(spark, sf_dir):
    """The whole job for the additive model, read back the way the forecast page does."""
    root = scratch_path(spark, "forecast")
    path = scratch_path(spark, "daily")
    gold_daily(spark, sf_dir).write.parquet(path)
    stored = spark.read.parquet(path)
    forecasting.run_forecast(spark, stored, root, "additive", "total_trips", 30, 2, AS_OF)
    view = readlayer.daily_view(stored, None, days=90, min_trips=MIN_TRIPS)
    page = forecasting.forecast_page(spark, root, view)
    return page.select("kind", "date", "value", (F.col("predicted") > 0).alias("has_forecast"))


@query
def forecast_additive_zones(spark, sf_dir):
    return models.forecast_additive(zone_series(spark, sf_dir), 30, key="zone")
