"""One state for stream and batch loads, rows without an identity, checks by month."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from farelake.functions.fixed import SOURCE_COLUMNS
from farelake.operators import dq, gold, merge
from farelake.operators.fact import MONTH_COLUMN, with_month
from farelake.plans import gold as gold_plan
from farelake.plans import load
from farelake.sources import bronze
from farelake.sources.state import read_state, write_state
from farelake.streaming.trips import stream_trips
from tests.frames import fact_rows, raw_by_month
from tests.test_jobs import same


def nameless(df):
    """Every fifth trip of February and March has no known pickup zone, so no key."""
    return df.withColumn("PULocationID", F.when(~F.col("month").isin("02", "03") | (F.col("DOLocationID") % 5 > 0), F.col("PULocationID")))


@pytest.fixture
def paths(tmp_path):
    return [str(tmp_path / name) for name in ("bronze", "lake", "checkpoint")]


def rows(spark, lake):
    return load.read_fact(spark, lake).drop("_loaded_at")


def test_stream_then_batch(spark, paths):
    root, lake, checkpoint = paths
    months = nameless(raw_by_month(spark))
    bronze.bronze_land_months(months.filter("year = 1997 AND month < '04'"), root)
    stream_trips(spark, root, lake, checkpoint, max_files_per_batch=2).awaitTermination()
    state = read_state(spark, lake)
    assert len(state.loads) >= 2 and state.pending == state.unchecked == [None] and state.watermark.startswith("1997-03")
    gold_plan.build_gold(spark, lake, "pending")
    assert load.load_fact(spark, root, lake) == []  # the batch load re-reads nothing
    bronze.bronze_land_months(months.filter("year = 1996 AND month = '05'"), root)  # a late month
    stream_trips(spark, root, lake, checkpoint).awaitTermination()
    assert read_state(spark, lake).pending == ["1996-05-01"]
    bronze.bronze_land_months(months.filter("year = 1997 AND month = '04'"), root)
    assert load.load_fact(spark, root, lake) == [dt.date(1997, 4, 1)]
    before = rows(spark, lake).count()
    stream_trips(spark, root, lake, checkpoint).awaitTermination()  # sees the file that the batch has loaded
    assert rows(spark, lake).count() == before
    assert read_state(spark, lake).pending == ["1996-05-01", "1997-04-01"]
    gold_plan.build_gold(spark, lake, "pending")
    assert read_state(spark, lake).pending == []
    fct = load.read_fact(spark, lake)
    for name, stored in gold_plan.read_gold(spark, lake).items():
        assert same(getattr(gold, name)(fct), stored), name


def test_replays_change_nothing(spark, paths):
    """A batch whose commit was lost is merged again, trips without a key included."""
    root, lake, checkpoint = paths
    months = nameless(raw_by_month(spark))
    bronze.bronze_land_months(months.filter("year = 1997 AND month < '03'"), root)
    load.load_fact(spark, root, lake)
    bronze.bronze_land_months(months.filter("year = 1997 AND month = '03'"), root)
    lost = read_state(spark, lake)
    stream_trips(spark, root, lake, checkpoint).awaitTermination()
    before = rows(spark, lake).cache()
    assert before.filter("trip_id IS NULL").count() > 0
    assert before.filter("trip_id IS NULL AND _source_row IS NULL OR trip_id IS NOT NULL AND _source_row IS NOT NULL").count() == 0
    after = read_state(spark, lake)
    lost.number = after.number
    write_state(spark, lake, lost)  # as if the batch had died after its merge
    stream_trips(spark, root, lake, checkpoint + "-new").awaitTermination()
    load.load_fact(spark, root, lake, mode="by_month")
    assert same(before, rows(spark, lake))


def test_stand_in_for_a_key(spark, tmp_path):
    path = str(tmp_path / "fact")
    known = {"pickup_location_id": None}
    def place(df, n):
        return with_month(df).withColumns({c: F.when(F.col("trip_id").isNull(), F.lit(n)).cast("bigint") for c in SOURCE_COLUMNS})
    first = place(fact_rows(spark, {}, known), 1)
    merge.merge_partitioned(spark, path, first, ["trip_id"], MONTH_COLUMN, stand_in=SOURCE_COLUMNS)
    for n, want in ((1, 2), (2, 3), (2, 3)):
        merge.merge_partitioned(spark, path, place(fact_rows(spark, {}, known), n), ["trip_id"], MONTH_COLUMN, stand_in=SOURCE_COLUMNS)
        assert spark.read.parquet(path).count() == want
    unplaced = place(fact_rows(spark, known), None)  # without a place, rows are inserted, as ever
    for want in (4, 5):
        merge.merge_partitioned(spark, path, unplaced, ["trip_id"], MONTH_COLUMN, stand_in=SOURCE_COLUMNS)
        assert spark.read.parquet(path).count() == want


def report(df):
    return sorted(tuple(r) for r in df.select("table_name", "column_name", "test_name", "failures", "severity", "passed").collect())


def test_checks_by_month_add_up(spark, paths):
    root, lake, _ = paths
    months = raw_by_month(spark)
    bronze.bronze_land_months(months.filter("year = 1997 AND month < '04'"), root)
    load.load_trips(spark, root, lake)
    assert read_state(spark, lake).unchecked == []
    doubled = months.filter("year = 1997 AND month = '04'")
    bronze.bronze_land_months(doubled.unionAll(doubled.limit(7)), root)
    stored = load.load_trips(spark, root, lake)
    fct = load.read_fact(spark, lake)
    tables = {n: fct if n == "fct_trips" else spark.read.parquet(f"{lake}/{n}") for n in dq.DECLARED_CHECKS}
    added_up = report(stored)
    assert added_up == report(dq.dq_report(tables)) == report(load.check_quality(spark, lake))
    assert [r[3] for r in added_up if r[:3] == ("fct_trips", "trip_id", "unique")] == [7]
    with pytest.raises(ValueError, match="unknown months"):
        load.check_quality(spark, lake, "all")


def test_a_check_of_one_month_reads_that_month(spark, paths):
    root, lake, _ = paths
    months = raw_by_month(spark)
    bronze.bronze_land_months(months.filter("year = 1997"), root)
    load.load_trips(spark, root, lake)
    fct = load.read_fact(spark, lake).filter(F.col(MONTH_COLUMN) == dt.date(1997, 5, 1))
    checks = dq.checks_by(fct, MONTH_COLUMN, dq.DECLARED_CHECKS["fct_trips"])
    plan = checks._sc._jvm.PythonSQLUtils.explainString(checks._jdf.queryExecution(), "formatted")
    assert plan.count("PartitionFilters: [isnotnull(pickup_month") == plan.count("Location: InMemoryFileIndex") > 0
    # Nulls written into another month go unseen until that month is checked, too.
    broken = load.read_fact(spark, lake).filter(F.col(MONTH_COLUMN) == dt.date(1997, 6, 1)).withColumn("pickup_datetime", F.lit(None).cast("timestamp_ntz"))
    lost = broken.collect()
    merge.write_clustered(spark.createDataFrame(lost, broken.schema), load.fact_path(lake))
    failures = lambda df: df.filter("column_name = 'pickup_datetime'").first().failures
    assert failures(load.check_quality(spark, lake, [dt.date(1997, 5, 1)])) == 0
    assert failures(load.check_quality(spark, lake, [dt.date(1997, 6, 1)])) == len(lost) > 0
