"""What must hold after crashes, in other session zones, and for series that are too regular or too short."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelake.functions import trips
from farelake.operators import models, series
from farelake.plans import forecast, load
from farelake.sources import bronze, tables
from farelake.sources.state import read_state
from tests.frames import raw_by_month


def test_regular_and_short_series():
    assert models.sarma_ahead(np.full(200, 7.0), 3)[0].tolist() == [7, 7, 7]
    week = np.arange(200) % 7 + 0.5 * np.arange(200)
    assert np.allclose(models.sarma_ahead(week, 5)[0], np.arange(200, 205) % 7 + 0.5 * np.arange(200, 205))
    for ahead in (models.sarma_ahead, models.holtwinters_ahead):
        forecast_, note = ahead(np.arange(20.0), 3)
        assert forecast_ is None and note.startswith("too short: 20 days")


def test_training_stops_at_as_of(spark):
    days = spark.range(1000).select(F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("pickup_date"))
    columns = ("year", "month", "day_of_week", "total_trips", "total_revenue", "avg_trip_revenue", "avg_distance_miles", "avg_duration_minutes")
    daily = days.select("pickup_date", *(F.lit(1).alias(c) for c in columns))
    span = series.training_frame(daily, years=1, as_of=dt.date(2001, 6, 30)).agg(F.min("ds"), F.max("ds")).first()
    assert tuple(span) == (dt.date(2000, 6, 30), dt.date(2001, 6, 30))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Europe/Berlin"])
def test_duration_knows_no_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("SELECT timestamp_ntz'2024-03-10 01:30:00' AS pickup_datetime, timestamp_ntz'2024-03-10 03:30:59' AS dropoff_datetime "
                       "UNION ALL SELECT timestamp_ntz'2024-03-31 01:30:00', timestamp_ntz'2024-03-31 03:30:59'")
        assert [r[0] for r in df.select(trips.duration_minutes()).collect()] == [120, 120]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_table_is_put_back(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(3), path)
    (tmp_path / "t").rename(tmp_path / "t__old-abc")  # a job that died between its two renames
    (tmp_path / "t__next-abc").mkdir()
    tables.repair_table(spark, path)
    assert spark.read.parquet(path).count() == 3
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_crashed_first_load_starts_over(spark, tmp_path):
    root, lake = str(tmp_path / "bronze"), str(tmp_path / "lake")
    months = raw_by_month(spark).filter("year = 1997")
    bronze.bronze_land_months(months, root)
    (tmp_path / "lake" / "fct_trips").mkdir(parents=True)  # an empty folder is no table
    load.load_fact(spark, root, lake)
    count = load.read_fact(spark, lake).count()
    assert count > 0
    assert load.load_fact(spark, root, lake) == []  # nothing new
    state = read_state(spark, lake)
    assert len(state.loads) == 1 and state.watermark.startswith("1997-12")
    bronze.bronze_land_months(raw_by_month(spark).filter("year = 1998 AND month = '01'"), root)
    assert load.load_fact(spark, root, lake) == [dt.date(1998, 1, 1)]
    assert load.read_fact(spark, lake).count() > count


def test_failed_run_is_logged(spark, tmp_path):
    columns = ("year", "month", "day_of_week", "total_trips", "total_revenue", "avg_trip_revenue", "avg_distance_miles", "avg_duration_minutes")
    daily = spark.createDataFrame([(dt.date(2001, 1, d),) for d in range(1, 31)], "pickup_date date").select(
        "pickup_date", *(F.lit(1).cast("double").alias(c) for c in columns))
    with pytest.raises(Exception):
        forecast.run_forecast(spark, daily, str(tmp_path), "sarma", "total_trips", 7, 2, dt.date(2001, 1, 30))
    assert [r.status for r in spark.read.parquet(f"{tmp_path}/ml_runs").collect()] == ["FAILED"]


def test_panel_of_trees(spark):
    days = spark.range(140).select(F.date_add(F.lit("2023-01-02").cast("date"), F.col("id").cast("int")).alias("ds"))
    panel = days.select("ds", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("key")).withColumn(
        "y", F.when(F.col("key") == "a", 1.0).otherwise(10.0) * (10 + 10 * F.weekday("ds")))
    got = models.forecast_gbt(panel, 7, trees=20, key="key")
    off = got.withColumn("y", F.when(F.col("key") == "a", 1.0).otherwise(10.0) * (10 + 10 * F.weekday("ds")))
    assert got.count() == 14 and off.agg(F.max(F.abs(F.col("forecast") / F.col("y") - 1))).first()[0] < 0.5
