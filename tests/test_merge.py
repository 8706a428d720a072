import datetime as dt
import glob
import os

import pytest

from farelake.operators import dq, merge
from farelake.operators.fact import MONTH_COLUMN, fct_trips, incremental_filter
from farelake.sources.tables import replace_table, write_clustered
from tests.frames import fact_rows, staged_rows

KEYS = ["trip_id"]


def put(spark, path, source, **options):
    merge.merge_partitioned(spark, path, source, KEYS, MONTH_COLUMN, **options)
    return spark.read.parquet(path)


def test_first_load_and_rerun(spark, tmp_path):
    path = str(tmp_path / "fact")
    three = fact_rows(spark, {}, {"fare_amount": 21.0}, {"fare_amount": 22.0})
    assert put(spark, path, three).count() == 3
    assert put(spark, path, three).count() == 3


def test_update_leaves_other_rows_alone(spark, tmp_path):
    path = str(tmp_path / "fact")
    put(spark, path, fact_rows(spark, {}, {"fare_amount": 21.0}))
    stored = put(spark, path, fact_rows(spark, {"tip_amount": 2.0}, {"fare_amount": 30.0}))
    assert sorted((r.fare_amount, r.tip_amount) for r in stored.collect()) == [(20.0, 2.0), (21.0, 1.0), (30.0, 1.0)]


def test_null_keys_are_inserted_every_time_and_fail_the_check(spark, tmp_path):
    path = str(tmp_path / "fact")
    nameless = fact_rows(spark, {"pickup_location_id": None})
    put(spark, path, nameless)
    stored = put(spark, path, nameless)
    assert stored.count() == 2
    assert dq.dq_not_null(stored, ["trip_id"]).first().failures == 2
    assert dq.dq_unique(stored, "trip_id").first().failures == 0


def test_duplicate_policies(spark, tmp_path):
    path = str(tmp_path / "fact")
    twice = fact_rows(spark, {"tip_amount": 2.0, "_loaded_at": dt.datetime(2024, 3, 2)}, {"tip_amount": 9.0, "_loaded_at": dt.datetime(2024, 3, 1)})
    assert put(spark, path, twice).count() == 2  # a new key: both are inserted
    with pytest.raises(ValueError, match="several source rows"):
        put(spark, path, twice)
    kept = put(spark, path, twice, on_duplicate="keep_one", newest=["_loaded_at"]).collect()
    assert [r.tip_amount for r in kept] == [2.0]
    with pytest.raises(ValueError, match="several source rows"):
        put(spark, str(tmp_path / "other"), twice, on_duplicate="error_any")
    with pytest.raises(ValueError, match="unknown policy"):
        put(spark, path, twice, on_duplicate="ignore")


def files_of(path, month):
    return {
        name: (os.path.getmtime(name), os.path.getsize(name))
        for name in glob.glob(f"{path}/{MONTH_COLUMN}={month}/*.parquet")
    }


def test_late_month(spark, tmp_path):
    path = str(tmp_path / "fact")
    february = {"pickup_datetime": dt.datetime(2024, 2, 3, 8), "dropoff_datetime": dt.datetime(2024, 2, 3, 9)}
    put(spark, path, fact_rows(spark, february))
    before = files_of(path, "2024-02-01")
    stored = spark.read.parquet(path)
    january = staged_rows(spark, {})
    assert incremental_filter(january, stored, "watermark").count() == 0
    assert incremental_filter(staged_rows(spark, february), stored, "watermark").count() == 1  # >=, not >
    assert incremental_filter(january, None).count() == 1
    assert incremental_filter(january, stored.filter("false")).count() == 1
    with pytest.raises(ValueError, match="unknown mode"):
        incremental_filter(january, stored, "latest")
    from farelake.operators.fact import with_month

    late = with_month(fct_trips(incremental_filter(january, stored, "by_month")))
    assert put(spark, path, late).count() == 2
    assert files_of(path, "2024-02-01") == before and before


def test_files_are_sorted_by_zone(spark, tmp_path):
    path = str(tmp_path / "fact")
    write_clustered(fact_rows(spark, *[{"pickup_location_id": z} for z in (9, 3, 7, 1, 5)]), path)
    for name in glob.glob(f"{path}/*/*.parquet"):
        zones = [r.pickup_location_id for r in spark.read.parquet(name).collect()]
        assert zones == sorted(zones)


def test_replace_table_reads_its_own_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    stored = replace_table(spark.range(10), path)
    assert replace_table(stored.filter("id < 4"), path).count() == 4
    assert os.listdir(tmp_path) == ["t"]


def test_hot_duplicate_key_is_combined_before_the_shuffle(spark):
    source = fact_rows(spark, {})
    plan = merge.keep_one(source, KEYS, ["_loaded_at"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_a_heavy_month_is_written_by_many_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "256k")
    try:
        month = F.when(F.col("id") % 10 < 9, F.lit("2024-01-01")).otherwise(F.lit("2024-02-01")).cast("date")
        rows = spark.range(0, 200_000, 1, 8).select(
            month.alias(MONTH_COLUMN),
            (F.xxhash64("id") % 263).alias("pickup_location_id"),
            F.xxhash64("id", F.lit(1)).alias("dropoff_location_id"),
        )
        write_clustered(rows, str(tmp_path / "fact"))
    finally:
        spark.conf.set(size, before)
    heavy = glob.glob(f"{tmp_path}/fact/{MONTH_COLUMN}=2024-01-01/*.parquet")
    assert len(heavy) >= 4
    counts = [spark.read.parquet(name).count() for name in heavy]
    assert sum(counts) == 180_000 and max(counts) < 90_000


def test_hot_zone_counts_like_brute_force(spark):
    from collections import Counter

    from farelake.operators import gold

    pairs = [(7, 7)] * 40 + [(7, z) for z in range(20)] + [(z, 9) for z in range(20)]
    rows = fact_rows(spark, *[{"pickup_location_id": a, "dropoff_location_id": b} for a, b in pairs])
    picked, dropped = Counter(a for a, _ in pairs), Counter(b for _, b in pairs)
    found = {r.location_id: (r.pickup_trips, r.dropoff_trips, r.popularity_rank) for r in gold.location_stats(rows).collect()}
    totals = {z: picked[z] + dropped[z] for z in picked | dropped}
    want = {z: (picked[z], dropped[z], 1 + sum(t > totals[z] for t in totals.values())) for z in totals}
    assert found == want


def test_keep_one_moves_only_copies(spark):
    """Rows whose key comes once stay where they were read; the choice among copies is that of keep_one."""
    alone = fact_rows(spark, {}, {"fare_amount": 21.0}, {"pickup_location_id": None})
    assert merge.resolve_duplicates(None, alone, KEYS, "keep_one", ["_loaded_at"]) is alone
    copies = fact_rows(spark, {}, {"tip_amount": 7.0}, {"tip_amount": 9.0}, {"fare_amount": 21.0}, *[{"pickup_location_id": None}] * 2)
    got = merge.resolve_duplicates(None, copies, KEYS, "keep_one", ["_loaded_at"])
    want = merge.keep_one(copies, KEYS, ["_loaded_at"])
    assert got.columns == copies.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.count() == 4
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "BroadcastHashJoin" in plan


def test_settled_source_is_not_copied(spark, tmp_path, monkeypatch):
    """Only the keys of settled rows are kept aside; months that held nothing are written where their rows were read."""
    path, other = str(tmp_path / "fact"), str(tmp_path / "other")
    march = {"pickup_datetime": dt.datetime(2024, 3, 3, 8), "dropoff_datetime": dt.datetime(2024, 3, 3, 9)}
    again = fact_rows(spark, {"tip_amount": 2.0}, {"fare_amount": 30.0}, march, {**march, "pickup_location_id": None})
    aside = []
    monkeypatch.setattr(merge, "scratch_path", lambda _, label: aside.append(str(tmp_path / f"{label}-{len(aside)}")) or aside[-1])
    for to, settled in ((path, True), (other, False)):
        put(spark, to, fact_rows(spark, {}, {"fare_amount": 21.0}))
        for policy in ("error", "keep_one"):
            merge.merge_partitioned(spark, to, again, KEYS, MONTH_COLUMN, on_duplicate=policy, newest=["_loaded_at"], settled=settled)
    columns = spark.read.parquet(path).columns
    rows = [sorted(map(str, spark.read.parquet(to).select(columns).collect())) for to in (path, other)]
    assert rows[0] == rows[1] and len(rows[0]) == 6
    kept = [set(spark.read.parquet(a).columns) for a in aside if "merge-source" in a]
    assert kept[0] == kept[1] == {"trip_id", MONTH_COLUMN}
