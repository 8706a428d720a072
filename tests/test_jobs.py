"""Whole jobs: load, gold, dashboard, stream and forecast."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from farelake.operators import gold, models, series
from farelake.operators.fact import fct_trips, incremental_filter
from farelake.operators.staging import stg_trips
from farelake.plans import dashboard, forecast, load
from farelake.plans import gold as gold_plan
from farelake.sources import bronze
from farelake.streaming.trips import stream_trips
from tests.frames import SMALL, raw_by_month
from harness.fixture import raw_trips


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    bronze_root, path = str(root / "bronze"), str(root / "lake")
    bronze.bronze_land_months(raw_by_month(spark), bronze_root)
    report = load.load_trips(spark, bronze_root, path)
    assert report.count() == 14
    gold_plan.build_gold(spark, path)
    return bronze_root, path


@pytest.fixture(scope="module")
def direct(spark):
    return fct_trips(stg_trips(raw_trips(spark, SMALL)))


def same(a, b):
    b = b.select(*a.columns)
    doubles = [c for c, t in a.dtypes if t == "double"]
    a, b = (df.withColumns({c: F.round(c, 6) for c in doubles}) for df in (a, b))
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stored_fact_equals_direct(spark, lake, direct):
    stored = load.read_fact(spark, lake[1]).drop("pickup_month", "_loaded_at")
    assert same(direct.drop("_loaded_at"), stored)


def test_reload_changes_nothing(spark, lake):
    before = load.read_fact(spark, lake[1]).count()
    load.load_fact(spark, *lake)
    load.load_fact(spark, *lake, mode="by_month", months=[(1996, 1), (1996, 2)])
    assert load.read_fact(spark, lake[1]).count() == before


@pytest.mark.parametrize("name", gold_plan.TABLES)
def test_stored_gold_equals_direct(spark, lake, direct, name):
    assert same(getattr(gold, name)(direct), gold_plan.read_gold(spark, lake[1])[name])


def test_refresh_of_changed_months_equals_a_full_build(spark, tmp_path):
    bronze_root, path = str(tmp_path / "bronze"), str(tmp_path / "lake")
    months = raw_by_month(spark)
    bronze.bronze_land_months(months.filter("year < 2000"), bronze_root)
    assert load.load_fact(spark, bronze_root, path) is None
    gold_plan.build_gold(spark, path)
    bronze.bronze_land_months(months.filter("year = 2000 AND month <= '02'"), bronze_root)
    changed = load.load_fact(spark, bronze_root, path, mode="by_month", months=[(1999, 12), (2000, 1), (2000, 2)])
    assert sorted(changed) == [dt.date(1999, 12, 1), dt.date(2000, 1, 1), dt.date(2000, 2, 1)]
    gold_plan.build_gold(spark, path, months=changed)
    fct = load.read_fact(spark, path)
    for name, stored in gold_plan.read_gold(spark, path).items():
        assert same(getattr(gold, name)(fct), stored), name


def test_gold_properties(spark, lake):
    fct, g = load.read_fact(spark, lake[1]), gold_plan.read_gold(spark, lake[1])
    clean = gold.clean_trips(fct).count()
    total = lambda df, c: df.agg(F.sum(c)).first()[0]
    assert total(g["daily_summary"], "total_trips") == fct.count()
    assert total(g["location_stats"], "pickup_trips") == total(g["location_stats"], "dropoff_trips") == clean
    assert total(g["monthly_trends"], "total_trips") == total(g["year_over_year"], "total_trips") == clean
    assert total(g["hourly_patterns"], "total_trips") == clean and g["hourly_patterns"].count() <= 168
    assert total(g["trip_distance_distribution"], "pct_of_total") == pytest.approx(100, abs=0.05)
    for name, share in (("payment_analysis", "pct_of_monthly_trips"), ("vendor_comparison", "market_share_pct")):
        worst = g[name].groupBy("year_month").agg(F.abs(F.sum(share) - 100).alias("off")).agg(F.max("off")).first()[0]
        assert worst < 0.1


def test_dashboard(spark, lake):
    frames = dashboard.dashboard(spark, lake[1], min_trips=2)
    assert len(frames) == 10
    assert frames["kpis"].first().total_trips > 0
    assert [r.day_name for r in frames["heatmap"].collect()][0] == "Monday" and len(frames["heatmap"].columns) == 26
    assert frames["top_zones"].count() == 20
    months = [r.year_month for r in frames["monthly"].collect()]
    assert months == sorted(months) and len(months) > 60


def test_stream_in_two_runs_equals_batch(spark, tmp_path, direct):
    root, target, checkpoint = (str(tmp_path / n) for n in ("bronze", "fact", "checkpoint"))
    months = raw_by_month(spark)
    bronze.bronze_land_months(months.filter("year = 1997"), root)
    stream_trips(spark, root, target, checkpoint, max_files_per_batch=7).awaitTermination()
    bronze.bronze_land_months(months.filter("year = 1996"), root)  # a late year
    for _ in range(2):
        stream_trips(spark, root, target, checkpoint).awaitTermination()
    stored = load.read_fact(spark, target).drop("pickup_month", "_loaded_at")
    # File months and pickup months agree in the fixture, so years select the same trips on both sides.
    assert same(direct.filter(F.year("pickup_date").isin(1996, 1997)).drop("_loaded_at"), stored)


def synthetic(spark, keys=1):
    days = spark.range(400).select(F.date_add(F.lit("2023-01-02").cast("date"), F.col("id").cast("int")).alias("ds"), "id")
    y = 100 + 0.1 * F.col("id") + 10 * F.weekday("ds").isin(5, 6).cast("int")
    keyed = days.crossJoin(spark.range(keys).select(F.concat(F.lit("k"), F.col("id")).alias("key")))
    return keyed.select("key", "ds", y.cast("double").alias("y"))


@pytest.mark.parametrize("name,trees", [("additive", None), ("sarma", None), ("holtwinters", None), ("gbt", 20)])
def test_models_beat_the_mean(spark, tmp_path, name, trees):
    synthetic(spark).drop("key").write.parquet(str(tmp_path / "series"))
    tagged = series.holdout_split(spark.read.parquet(str(tmp_path / "series")), 28)
    train, held_out = tagged.filter("NOT is_validation"), tagged.filter("is_validation")
    predicted = models.MODELS[name](train, 28, **({"trees": trees} if trees else {}))
    scores = series.forecast_metrics(series.validation_frame(held_out, predicted)).first()
    flat = train.agg(F.avg("y")).first()[0]
    baseline = held_out.agg(F.avg(F.abs(F.col("y") - flat))).first()[0]
    assert scores.mae < baseline
    days = sorted(r.ds for r in predicted.collect())
    assert days == [dt.date(2024, 1, 9) + dt.timedelta(days=i) for i in range(28)]


@pytest.mark.parametrize("name", ["sarma", "holtwinters"])
def test_recursive_models_follow_each_series(spark, name):
    predicted = models.MODELS[name](synthetic(spark, keys=5), 14, key="key")
    found = predicted.groupBy("key").agg(F.count("*").alias("n"), F.avg("forecast").alias("m")).collect()
    assert len(found) == 5 and {r.n for r in found} == {14}
    assert all(abs(r.m - 143) < 3 for r in found)
    short = models.MODELS[name](synthetic(spark).limit(5), 7, key="key")
    assert short.count() == 7


@pytest.mark.parametrize("name", ["additive", "sarma", "holtwinters"])
def test_held_out_days_with_gaps_are_all_predicted(spark, name):
    gappy = synthetic(spark).filter("day(ds) != 13").select("ds", "y")
    tagged = series.holdout_split(gappy, 60)
    train, held_out = tagged.filter("NOT is_validation"), tagged.filter("is_validation")
    predicted = models.MODELS[name](train, 60, held_out)
    assert series.validation_frame(held_out, predicted).count() == 60


def test_forecast_job(spark, lake, tmp_path):
    root = str(tmp_path / "forecasts")
    daily = gold_plan.read_gold(spark, lake[1])["daily_summary"]
    as_of = dt.date(2001, 6, 30)
    ids = [
        forecast.run_forecast(spark, daily, root, model, "total_trips", 14, 2, as_of)
        for model in ("additive", "holtwinters")
    ]
    logged = {r.run_id: r for r in spark.read.parquet(f"{root}/ml_runs").collect()}
    assert set(logged) == set(ids)
    params = logged[ids[0]].params
    assert params["validation_samples"] == "14" and re.match(r"additive_total_trips_trained_until_2001\d{4}$", logged[ids[0]].run_name)
    assert set(logged[ids[0]].metrics) == {"mae", "rmse", "mape"}
    page = forecast.forecast_page(spark, root, daily.select("pickup_date", "total_trips"), days=10)
    kinds = {r.kind: r["count"] for r in page.groupBy("kind").count().collect()}
    assert kinds == {"history": 10, "validation": 14, "forecast": 14}
    with pytest.raises(ValueError, match="unknown model"):
        forecast.run_forecast(spark, daily, root, "lstm")


def test_argument_checks(spark, lake):
    daily = gold_plan.read_gold(spark, lake[1])["daily_summary"]
    with pytest.raises(ValueError, match="unknown metric"):
        series.training_frame(daily, "tips")
    with pytest.raises(ValueError, match="years"):
        series.training_frame(daily, years=11)
    with pytest.raises(ValueError, match="horizon"):
        series.future_dates(daily, 366)
    assert set(series.TIME_FEATURES) <= set(series.time_features(spark.sql("SELECT date'2024-01-31' AS ds")).columns)


# --- plans ---------------------------------------------------------------------------------------------


def explained(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_gold_scans_read_only_their_columns(spark, lake):
    plan = explained(gold.hourly_patterns(load.read_fact(spark, lake[1])))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(c.split(":")[0] for c in schema.split(",")) == {
        "pickup_hour", "pickup_date", "trip_distance_miles", "trip_duration_minutes",
        "avg_speed_mph", "tip_amount", "total_amount", "has_data_quality_issue",
    }
    assert "EqualTo(has_data_quality_issue,false)" in plan or "Not(EqualTo(has_data_quality_issue,true))" in plan


def test_location_stats_reads_the_fact_once(spark, lake):
    plan = explained(gold.location_stats(load.read_fact(spark, lake[1])))
    assert len(re.findall(r"^\(\d+\) Scan parquet", plan, re.M)) == 1


def test_fact_needs_no_shuffle_and_pushes_its_filter(spark, lake):
    plan = explained(fct_trips(stg_trips(bronze.bronze_scan(spark, lake[0]))))
    assert "Exchange" not in plan
    assert "GreaterThanOrEqual(trip_distance,0.0)" in plan and "GreaterThanOrEqual(fare_amount,0.0)" in plan


def test_watermark_reaches_the_raw_scan(spark, lake):
    staged = stg_trips(bronze.bronze_scan(spark, lake[0]))
    plan = explained(incremental_filter(staged, load.read_fact(spark, lake[1])))
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(tpep_pickup_datetime,", plan)


def test_month_filter_prunes_partitions(spark, lake):
    plan = explained(load.read_fact(spark, lake[1]).filter("pickup_month = date'1996-01-01'"))
    assert re.search(r"PartitionFilters: \[.*pickup_month", plan)
