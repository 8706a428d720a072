"""The daily rollup: one scan, exact numbers of zones, medians of any period without the fact."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from farelake.operators import gold
from farelake.operators.fact import fct_trips
from farelake.operators.staging import stg_trips
from farelake.plans import gold as gold_plan
from farelake.plans import load
from farelake.sources import bronze
from harness.fixture import raw_trips
from tests.frames import SMALL, fact_rows, raw_by_month


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("rollup") / "fact")
    fct_trips(stg_trips(raw_trips(spark, SMALL))).write.parquet(path)
    return spark.read.parquet(path)


def test_one_scan_without_expand(spark, stored):
    frame = gold.daily_summary(stored)
    plan = frame._sc._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")
    assert len(re.findall(r"^\(\d+\) Scan parquet", plan, re.M)) == 1
    assert "Expand" not in plan and "Join" not in plan


@pytest.mark.parametrize("finish,period,name", [
    (gold.monthly_summary_from, "trunc(pickup_date, 'MM')", "month_start"),
    (gold.yearly_summary_from, "cast(year(pickup_date) as bigint)", "year"),
])
def test_periods_equal_direct_counts(spark, stored, finish, period, name):
    got = finish(gold.day_rollup(stored))
    want = stored.groupBy(F.expr(period).alias(name)).agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.countDistinct("pickup_location_id").alias("unique_pickup_locations"),
        F.countDistinct("dropoff_location_id").alias("unique_dropoff_locations"),
        F.round(F.avg("trip_distance_miles"), 6).alias("avg_distance_miles"),
        F.percentile_approx("trip_distance_miles", 0.5, 1_000_000).alias("median_distance_miles"),
        F.percentile_approx("trip_duration_minutes", 0.5, 1_000_000).alias("median_duration_minutes"),
    )
    got = got.withColumn("avg_distance_miles", F.round("avg_distance_miles", 6)).select(*want.columns)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 < want.count()


def test_ids_of_every_range(spark):
    """Ids beyond one bitmap, below zero and unknown; a rollup in several parts a day."""
    ids = [1, 2, 2, 32768, 32769, 70000, -1, -40000, None, None]
    trips = [{"pickup_location_id": p, "dropoff_location_id": d, "pickup_datetime": dt.datetime(2024, 1, 10 + k % 2, 8), "dropoff_datetime": dt.datetime(2024, 1, 10 + k % 2, 9)}
             for k, (p, d) in enumerate((p, d) for p in ids for d in ids[::-2])]
    fct = fact_rows(spark, *trips)
    for frame, period in ((gold.daily_summary(fct), F.col("pickup_date")),
                          (gold.monthly_summary_from(gold.day_rollup(fct)), F.trunc("pickup_date", "MM"))):
        want = fct.groupBy(period.alias("p")).agg(
            F.countDistinct("pickup_location_id"), F.countDistinct("dropoff_location_id"), F.count(F.lit(1)))
        got = frame.select(frame.columns[0], "unique_pickup_locations", "unique_dropoff_locations", "total_trips")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_unknown_measures(spark):
    row = gold.daily_summary(fact_rows(spark, {}).withColumns({
        "trip_duration_minutes": F.lit(None).cast("bigint"), "trip_distance_miles": F.lit(None).cast("double"),
        "pickup_location_id": F.lit(None).cast("bigint")})).first()
    assert (row.median_duration_minutes, row.median_distance_miles, row.avg_distance_miles) == (None, None, None)
    assert (row.unique_pickup_locations, row.unique_dropoff_locations, row.total_trips) == (0, 1, 1)
    assert gold.daily_summary(fact_rows(spark)).count() == 0


def test_rank_error_of_medians(spark):
    """A day of 80,000 trips, and a month of such days."""
    n = 80_000
    day = spark.range(0, 3 * n, 1, 12).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("pickup_date"),
        (F.pmod(F.col("id") * 7919, F.lit(n * 3)) / 10.0).alias("trip_distance_miles"),
        F.pmod(F.col("id") * 104729, F.lit(n * 3)).alias("trip_duration_minutes"))
    plain = fact_rows(spark, {}).drop("pickup_date", "trip_distance_miles", "trip_duration_minutes", "pickup_month")
    fct = day.crossJoin(F.broadcast(plain))
    rollup = gold.day_rollup(fct)
    for row in [*gold.daily_summary_from(rollup).collect(), *gold.monthly_summary_from(rollup).collect()]:
        for median, scale in ((row.median_distance_miles, 10.0), (row.median_duration_minutes, 1.0)):
            assert abs(median * scale / (3 * n) - 0.5) < 0.005


def test_months_without_rows_lose_their_rollup(spark, tmp_path):
    root, lake = str(tmp_path / "bronze"), str(tmp_path / "lake")
    bronze.bronze_land_months(raw_by_month(spark).filter("year = 1997 AND month < '04'"), root)
    load.load_fact(spark, root, lake)
    gold_plan.build_gold(spark, lake)
    gone = dt.date(1997, 2, 1)
    path = tmp_path / "lake" / "fct_trips" / f"pickup_month={gone}"
    for file in path.iterdir():
        file.unlink()
    gold_plan.build_gold(spark, lake, months=[gone, dt.date(1997, 3, 1)])
    months = {r[0] for r in gold_plan.read_gold(spark, lake)["monthly_trends"].select("month_start_date").collect()}
    assert {m.month for m in months} == {1, 3}
    rollup = gold_plan.read_rollup(spark, lake, "by_day")
    assert gold.monthly_summary_from(rollup).count() == 2
