"""Semantics that are easy to get wrong, on rows small enough to check by eye."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from farelake.functions import calendar, labels, trips
from farelake.operators import dims, fact, gold, readlayer, reshape, series
from farelake.operators.staging import stg_trips
from farelake.schemas import FCT_TRIPS, STG_TRIPS, conform
from tests.frames import DEFAULTS, fact_rows, staged_rows

AT = dt.datetime(2024, 1, 10, 8, 0, 0)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


@pytest.mark.parametrize("field", trips.KEY_COLUMNS)
def test_trip_with_an_unknown_key_field_has_no_id(spark, field):
    assert one(staged_rows(spark, {field: None}).select(trips.trip_id().alias("id"))).id is None


def test_trip_ids_tell_neighbouring_fields_apart(spark):
    rows = staged_rows(
        spark,
        {"pickup_location_id": 1, "dropoff_location_id": 23},
        {"pickup_location_id": 12, "dropoff_location_id": 3},
        {"pickup_location_id": 12, "dropoff_location_id": 3, "vendor_id": 2},
    )
    ids = [r.id for r in rows.select(trips.trip_id().alias("id")).collect()]
    assert ids[0] != ids[1] and ids[1] == ids[2]  # the vendor is not part of the identity


@pytest.mark.parametrize("seconds,minutes", [(59, 0), (60, 1), (119, 1), (-59, 0), (-60, -1), (86400 * 400, 576000)])
def test_duration_counts_complete_minutes(spark, seconds, minutes):
    row = staged_rows(spark, {"dropoff_datetime": AT + dt.timedelta(seconds=seconds)})
    found = one(
        row.select(
            trips.duration_minutes().alias("m"),
            F.timestamp_diff("MINUTE", F.col("pickup_datetime"), F.col("dropoff_datetime")).alias("builtin"),
        )
    )
    assert found.m == found.builtin == minutes


def test_division_by_zero_is_null(spark):
    row = one(
        staged_rows(spark, {"dropoff_datetime": AT + dt.timedelta(seconds=30), "fare_amount": 0.0}).select(
            trips.speed_mph().alias("speed"), trips.tip_percentage().alias("tip")
        )
    )
    assert row.speed is None and row.tip is None


@pytest.mark.parametrize(
    "change,flagged",
    [
        ({}, False),
        ({"trip_distance_miles": 0.0}, True),
        ({"dropoff_datetime": AT + dt.timedelta(seconds=59), "trip_distance_miles": 0.1}, True),
        ({"fare_amount": -1.0}, True),
        ({"total_amount": -1.0}, True),
        ({"passenger_count": 0}, True),
        ({"passenger_count": 9}, False),
        ({"passenger_count": 10}, True),
        ({"passenger_count": None}, False),
        ({"trip_distance_miles": 50.0}, False),  # exactly 100 mph
        ({"trip_distance_miles": 50.1}, True),
        ({"dropoff_datetime": AT - dt.timedelta(minutes=5)}, True),
        ({"total_amount": None, "trip_distance_miles": None}, False),
    ],
)
def test_quality_flag(spark, change, flagged):
    assert one(staged_rows(spark, change).select(trips.quality_issue().alias("f"))).f is flagged


@pytest.mark.parametrize(
    "change,valid",
    [
        ({}, True),
        ({"trip_distance_miles": 0.0, "fare_amount": 0.0}, True),
        ({"pickup_datetime": None}, False),
        ({"dropoff_datetime": None}, False),
        ({"dropoff_datetime": AT}, False),
        ({"trip_distance_miles": -0.1}, False),
        ({"trip_distance_miles": None}, False),
        ({"fare_amount": None}, False),
        ({"fare_amount": -0.1}, False),
    ],
)
def test_valid_trips(spark, change, valid):
    assert fact.valid_trips(staged_rows(spark, change)).count() == int(valid)


def test_contracts(spark):
    rows = staged_rows(spark, {})
    assert conform(fact.fct_trips(rows), FCT_TRIPS).columns == FCT_TRIPS.fieldNames()
    with pytest.raises(ValueError, match="fare_amount: expected double, got string"):
        conform(rows.withColumn("fare_amount", F.lit("x")), STG_TRIPS)
    with pytest.raises(ValueError, match="no such column"):
        conform(rows.withColumn("extra_column", F.lit(1)), STG_TRIPS)


def test_fractional_counts_are_rounded(spark):
    raw = spark.sql(
        "SELECT 1 AS VendorID, timestamp_ntz'2024-01-01 00:00:00' AS tpep_pickup_datetime, "
        "timestamp_ntz'2024-01-01 00:10:00' AS tpep_dropoff_datetime, 1.6D AS passenger_count, "
        "1.0D AS trip_distance, 1L AS PULocationID, 2L AS DOLocationID, 1.0D AS RatecodeID, 'N' AS "
        "store_and_fwd_flag, 1L AS payment_type, 1D AS fare_amount, 0D AS extra, 0D AS mta_tax, 0D AS tip_amount,"
        " 0D AS tolls_amount, 0D AS improvement_surcharge, 1D AS total_amount, 0D AS congestion_surcharge, "
        "CAST(NULL AS DOUBLE) AS airport_fee"
    )
    row = one(conform(stg_trips(raw), STG_TRIPS))
    assert row.passenger_count == 2 and row.airport_fee is None


def test_times_without_zone_ignore_the_session_zone(spark):
    rows = staged_rows(spark, {"pickup_datetime": dt.datetime(2024, 3, 10, 1, 30), "dropoff_datetime": dt.datetime(2024, 3, 10, 2, 15)})
    row = one(fact.fct_trips(rows).select("pickup_hour", "dropoff_hour", "pickup_date"))
    assert (row.pickup_hour, row.dropoff_hour, row.pickup_date) == (1, 2, dt.date(2024, 3, 10))


def test_sunday_weeks_and_fiscal_years(spark):
    days = dims.dim_date(spark).filter("date_key IN ('2023-01-01', '2022-01-01', '2024-06-30', '2024-07-01', '2028-12-31')")
    found = {str(r.date_key): (r.week_of_year, r.fiscal_year, r.day_name) for r in days.collect()}
    assert found["2023-01-01"][0] == 1  # a Sunday
    assert found["2022-01-01"] == (0, 2022, "Saturday")
    assert found["2024-06-30"][1] == 2024 and found["2024-07-01"][1] == 2025
    assert found["2028-12-31"][0] == 53
    for day, (week, _, _) in found.items():
        assert week == int(dt.date.fromisoformat(day).strftime("%U"))


def test_fixed_dimensions(spark):
    assert dims.dim_date(spark).count() == 8035
    hours = {r.hour_key: r for r in dims.dim_time(spark).collect()}
    assert len(hours) == 24
    assert (hours[8].time_period, hours[8].is_rush_hour, hours[8].peak_category) == ("Morning", True, "Morning Peak")
    assert (hours[23].time_period, hours[23].is_rush_hour, hours[23].peak_category) == ("Evening", False, "Off-Peak")
    assert hours[7].hour_range == "07:00 - 07:59" and hours[7].hour_display == "07:00"


def test_bands_are_half_open_and_unknown_distance_is_last(spark):
    rows = spark.createDataFrame([(0.0,), (1.0,), (1.99,), (5.0,), (19.9,), (20.0,), (None,)], "d double")
    found = [
        (r.b, r.o) for r in rows.select(labels.distance_bucket(F.col("d")).alias("b"), labels.bucket_order(F.col("d")).alias("o")).collect()
    ]
    assert found == [
        ("0-1 miles", 1), ("1-2 miles", 2), ("1-2 miles", 2), ("5-10 miles", 4),
        ("10-20 miles", 5), ("20+ miles", 6), ("20+ miles", 6),
    ]
    assert gold.trip_distance_distribution(fact_rows(spark, {})).count() == 1


@pytest.mark.parametrize(
    "value,decimals,text",
    [(999, 0, "999"), (1500, 1, "1.5K"), (2_340_000, 2, "2.34M"), (7e9, 0, "7B"), (None, 0, None)],
)
def test_compact_number(spark, value, decimals, text):
    row = one(spark.createDataFrame([(None if value is None else float(value),)], "v double").select(labels.compact_number(F.col("v"), decimals).alias("t")))
    assert row.t == text


def test_zone_fare_is_the_plain_mean_of_both_ends(spark):
    rows = fact_rows(
        spark,
        {"pickup_location_id": 1, "dropoff_location_id": 2, "total_amount": 10.0},
        {"pickup_location_id": 1, "dropoff_location_id": 3, "total_amount": 20.0},
        {"pickup_location_id": 2, "dropoff_location_id": 1, "total_amount": 60.0},
    )
    zones = {r.location_id: r for r in gold.location_stats(rows).collect()}
    assert zones[1].avg_fare == (15.0 + 60.0) / 2 and zones[1].total_trips == 3
    assert (zones[1].popularity_rank, zones[2].popularity_rank, zones[3].popularity_rank) == (1, 2, 3)
    assert zones[3].pickup_trips == 0 and zones[3].dropoff_trips == 1


def test_previous_month_is_the_previous_present_one(spark):
    rows = fact_rows(
        spark,
        *[
            {"pickup_datetime": dt.datetime(2024, m, 5, 8), "dropoff_datetime": dt.datetime(2024, m, 5, 9)}
            for m in (1, 1, 4)
        ],
    )
    found = {r.month: r for r in gold.monthly_trends(rows).collect()}
    assert found[1].prev_month_trips is None and found[4].prev_month_trips == 2
    yearly = one(gold.year_over_year(rows))
    assert yearly.trips_yoy_change_pct is None


def test_daily_summary_counts_flagged_trips_and_the_rest_do_not(spark):
    rows = fact_rows(spark, {}, {"passenger_count": 0})
    day = one(gold.daily_summary(rows))
    assert (day.total_trips, day.trips_with_issues, day.pct_trips_with_issues) == (2, 1, 50.0)
    assert one(gold.hourly_patterns(rows)).total_trips == 1


DAY = "pickup_date date, total_trips bigint, total_revenue double, avg_trip_revenue double, total_distance_miles double, avg_tip double"


def test_last_valid_date(spark):
    d = dt.date
    daily = spark.createDataFrame(
        [
            (d(2024, 1, 1), 500, 9000.0, 18.0, 1.0, 1.0),
            (d(2024, 1, 2), 100, 1800.0, 18.0, 1.0, 3.0),  # exactly the threshold: too few
            (d(2024, 1, 3), 500, 150000.0, 300.0, 1.0, 1.0),  # implausible fares
        ],
        DAY,
    )
    last = readlayer.last_valid_date(daily)
    assert one(last).last_valid_date == d(2024, 1, 1)
    assert one(readlayer.last_valid_month(last)).last_valid_month == "2024-01"
    for limit in (last, d(2024, 1, 1)):
        assert one(readlayer.kpi_summary(daily, limit)).total_days == 1
    # No plausible day at all: no limit is applied.
    none = readlayer.last_valid_date(daily, min_trips=10_000)
    assert one(none).last_valid_date is None
    everything = one(readlayer.kpi_summary(daily, none))
    assert everything.total_days == 3 and everything.avg_tip == (1 + 3 + 1) / 3  # mean of daily means
    empty = one(readlayer.kpi_summary(daily.filter("false")))
    assert (empty.total_trips, empty.total_revenue, empty.data_start_date) == (0, 0.0, None)


def test_best_run_keeps_its_own_missing_values(spark):
    rows = spark.createDataFrame(
        [
            ("gbt", "total_trips", None, 2.0, 9.0, "b", dt.datetime(2024, 1, 2)),
            ("gbt", "total_trips", 7.0, 1.0, 12.0, "a", dt.datetime(2024, 1, 1)),
            ("gbt", "total_trips", 1.0, 1.0, None, "c", dt.datetime(2024, 1, 1)),
        ],
        "model_type string, target_metric string, mae double, rmse double, mape double, run_id string, start_time timestamp",
    )
    best = one(reshape.best_per_model(rows))
    assert best.run_id == "b" and best.mae is None and best.target_metric == "total_trips"


def test_metrics_survive_a_true_zero(spark):
    frame = spark.createDataFrame([(dt.date(2024, 1, 1), 0.0, 0.0), (dt.date(2024, 1, 2), 10.0, 8.0)], "ds date, y_true double, y_pred double")
    found = one(series.forecast_metrics(frame))
    assert (found.mae, found.mape) == (1.0, 10.0)
    assert found.rmse == pytest.approx(2**0.5)


def test_month_helpers(spark):
    row = one(
        spark.sql("SELECT date'2024-02-29' AS d").select(
            calendar.year_month(F.col("d")).alias("ym"), calendar.month_start(F.col("d")).alias("ms")
        )
    )
    assert (row.ym, row.ms) == ("2024-02", dt.date(2024, 2, 1))
    assert DEFAULTS["vendor_id"] == 1
