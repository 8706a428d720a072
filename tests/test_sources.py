import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from farelake.operators import dq, reshape, runs
from farelake.operators.staging import stg_trips
from farelake.schemas import FORECAST_VALIDATION, FX_RATES, LOAD_LOG
from farelake.sources import bronze, fx, tables
from farelake.sources.zones import zone_source
from tests.frames import fact_rows, raw_by_month, staged_rows


def three_months(spark):
    return raw_by_month(spark).filter("year = 1996 AND month IN ('01', '02', '03')")


def test_land_one_month_twice(spark, tmp_path):
    inbox, root = str(tmp_path / "inbox"), str(tmp_path / "lake")
    months = three_months(spark)
    months.filter("month = '01'").drop("year", "month").write.parquet(inbox)
    for _ in range(2):
        folder = bronze.bronze_land(spark, inbox, root, 1996, 1)
    assert folder.endswith("/year=1996/month=01")
    scanned = bronze.bronze_scan(spark, root)
    assert scanned.count() == months.filter("month = '01'").count()
    assert {(r.year, r.month) for r in scanned.select("year", "month").distinct().collect()} == {(1996, 1)}


def test_drift_between_months(spark, tmp_path):
    root = str(tmp_path / "lake")
    months = three_months(spark)
    variants = (
        months.filter("month = '01'"),
        months.filter("month = '02'").withColumn("passenger_count", F.col("passenger_count").cast("double")),
        months.filter("month = '03'").withColumnRenamed("Airport_fee", "airport_fee"),
    )
    for variant in variants:
        bronze.bronze_land_months(variant, root)
    scanned = bronze.bronze_scan(spark, root)
    assert dict(scanned.dtypes)["passenger_count"] == "double"
    want = stg_trips(months.drop("year", "month")).drop("_loaded_at")
    have = stg_trips(scanned).drop("_loaded_at")
    assert have.dtypes == want.dtypes
    assert have.exceptAll(want).count() == want.exceptAll(have).count() == 0


def test_validate_and_log(spark, tmp_path):
    root, log = str(tmp_path / "lake"), str(tmp_path / "log")
    bronze.bronze_land_months(three_months(spark), root)
    empty = three_months(spark).filter("false").drop("year", "month")
    empty.coalesce(1).write.parquet(bronze.month_folder(root, 1996, 4))
    checked = bronze.bronze_validate(spark, root, expected=[(1996, 1), (1996, 4)])
    rows = {r.month: r for r in bronze.bronze_metrics(checked).collect()}
    assert rows[4].num_rows == 0 and rows[1].num_rows > 0
    assert {r.num_columns for r in rows.values()} == {19} and rows[1].file_size_mb >= 0
    bronze.log_load(checked, log)
    bronze.log_load(checked, log)
    assert spark.read.parquet(log).count() == 8 and set(spark.read.parquet(log).columns) == set(LOAD_LOG.fieldNames())
    with pytest.raises(ValueError, match="1996-05"):
        bronze.bronze_validate(spark, root, expected=[(1996, 5)])


def test_empty_lake(spark, tmp_path):
    os.makedirs(tmp_path / "empty")
    with pytest.raises(ValueError, match="no Parquet files"):
        bronze.bronze_scan(spark, str(tmp_path / "empty"))
    with pytest.raises(ValueError, match="no such folder"):
        bronze.bronze_scan(spark, str(tmp_path / "missing"))


FEED = """<?xml version="1.0" encoding="UTF-8"?>
<gesmes:Envelope xmlns:gesmes="urn:g"><Cube><Cube time="2025-01-02">
  <Cube currency="USD" rate="1.0321"/><Cube currency="JPY" rate="162.50"/>
</Cube></Cube></gesmes:Envelope>
"""


def test_fx_feed_to_table(spark, tmp_path):
    (tmp_path / "feed.xml").write_text(FEED)
    rates = fx.fx_extract(spark, str(tmp_path / "feed.xml"))
    assert {(r.base, r.quote, str(r.rate), r.feed_date) for r in rates.collect()} == {
        ("EUR", "USD", "1.032100", dt.date(2025, 1, 2)),
        ("EUR", "JPY", "162.500000", dt.date(2025, 1, 2)),
    }
    path = str(tmp_path / "fx_rates")
    assert fx.fx_table(spark, path).count() == 0
    friday, saturday = dt.date(2025, 1, 3), dt.date(2025, 1, 4)
    for run_date in (friday, friday, saturday):
        fx.fx_load(spark, path, rates, run_date)
    table = fx.fx_table(spark, path)
    assert table.schema == FX_RATES and table.count() == 4
    corrected = rates.withColumn("rate", F.lit("2").cast("decimal(18,6)")).withColumn("base", F.lit("XXX"))
    fx.fx_load(spark, path, corrected.filter("quote = 'USD'"), friday)
    found = {(r.quote_currency, r.run_date): (str(r.rate), r.base_currency) for r in fx.fx_table(spark, path).collect()}
    assert found[("USD", friday)] == ("2.000000", "XXX") and found[("USD", saturday)] == ("1.032100", "EUR")
    with pytest.raises(ValueError, match="several source rows"):
        fx.fx_load(spark, path, rates.unionByName(rates), friday)
    lazily = fx.fx_upsert(fx.fx_table(spark, path), corrected, saturday)
    assert lazily.count() == 4 and lazily.filter("rate = 2").count() == 3


def test_fx_records(spark):
    records = spark.createDataFrame([('[{"base":"EUR","quote":"USD","rate":"1.5"},{"base":"EUR","quote":"CHF","rate":0.9}]',)], "j string")
    assert {(r.quote, str(r.rate)) for r in fx.fx_records(records, "j").collect()} == {("USD", "1.500000"), ("CHF", "0.900000")}


GEOJSON = """{ "type": "FeatureCollection",
  "features": [
    {"type": "Feature", "geometry": {"type": "Point", "coordinates": [1, 2]},
     "properties": {"LocationID": 1, "zone": "Newark Airport", "borough": "EWR"}},
    {"type": "Feature", "geometry": null, "properties": {"LocationID": 2}},
    {"type": "Feature", "geometry": null, "properties": {"zone": "nowhere"}}
  ] }
"""


def test_zone_file_and_lookup(spark, tmp_path):
    (tmp_path / "zones.geojson").write_text(GEOJSON)
    zones = zone_source(spark, str(tmp_path / "zones.geojson"))
    assert {tuple(r) for r in zones.collect()} == {(1, "Newark Airport", "EWR"), (2, "Zone 2", "Unknown")}
    trips = spark.createDataFrame([(1,), (7,)], "location_id bigint")
    found = {r.location_id: (r.zone_name, r.borough) for r in reshape.zone_lookup(trips, zones).collect()}
    assert found == {1: ("Newark Airport", "EWR"), 7: ("Zone 7", "Unknown")}


def test_lookup_side_beyond_the_bound_is_not_broadcast(spark):
    from farelake.functions.sizing import broadcast_if_small

    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in plan(broadcast_if_small(spark.range(5), max_bytes=40))
    assert "ResolvedHint" not in plan(broadcast_if_small(spark.range(6), max_bytes=40))


def test_csv_and_json(spark, tmp_path):
    frame = spark.createDataFrame([(dt.date(2024, 1, 1), 1.5, None), (dt.date(2024, 1, 2), 2.0, 3.0)], FORECAST_VALIDATION)
    tables.csv_sink(frame, str(tmp_path / "csv"))
    back = tables.csv_source(spark, str(tmp_path / "csv"), FORECAST_VALIDATION)
    assert sorted(back.collect()) == sorted(frame.collect())
    records = sorted(r.record for r in tables.json_records(frame).collect())
    assert records[0] == '{"ds":"2024-01-01","y_true":1.5,"y_pred":null}'


def test_quality_report(spark):
    good, bad = fact_rows(spark, {}), fact_rows(spark, {}, {}, {"pickup_location_id": None})
    report = {(r.column_name, r.test_name): r for r in dq.dq_report({"fct_trips": bad}).collect()}
    assert len(report) == 4
    unique, known = report[("trip_id", "unique")], report[("trip_id", "not_null")]
    assert (unique.failures, unique.should_warn, unique.should_error) == (1, True, False)
    assert (known.failures, known.should_warn, known.should_error) == (1, False, True)
    assert dq.require_passing(dq.dq_report({"fct_trips": good})).filter("passed").count() == 4
    with pytest.raises(ValueError, match=r"not_null\(fct_trips.trip_id\): 1"):
        dq.require_passing(dq.dq_report({"fct_trips": bad}))
    assert dq.duplicated_values(staged_rows(spark, {}, {}), "vendor_id").first().n_records == 2


def test_view_and_run_log(spark, tmp_path):
    tables.replace_view(spark.range(3), "three_rows")
    assert spark.table("three_rows").count() == 3
    path = str(tmp_path / "runs")
    for i, name in enumerate((None, "named")):
        runs.log_run(spark, path, f"abcdefgh-{i}", name, "FINISHED", dt.datetime(2024, 1, 1 + i), {"model_type": "gbt", "n": 3}, {"mape": 12})
    recent = runs.recent_runs(spark.read.parquet(path), 5).collect()
    assert [r.run_name for r in recent] == ["named", "abcdefgh"]
    assert (recent[0].target_metric, recent[0].forecast_horizon, recent[0].mae, recent[0].mape) == ("unknown", "N/A", None, 12.0)
    assert [r.grade for r in runs.graded_runs(spark.read.parquet(path)).collect()] == ["fair", "fair"]
    assert runs.run_name("gbt", "total_trips", dt.date(2024, 1, 31)) == "gbt_total_trips_trained_until_20240131"
