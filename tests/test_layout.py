"""How stored tables lie in files: order by both zones, compaction of append tables."""

import datetime as dt
import pathlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from farelake.operators import runs
from farelake.schemas import LOAD_LOG, ML_RUNS
from farelake.sources import tables


def plain_place(a, b):
    return sum(((a >> i & 1) << (2 * i + 1)) | ((b >> i & 1) << (2 * i)) for i in range(16))


def test_curve(spark):
    pairs = [(1, 2), (255, 0), (0, 255), (65535, 65535), (70000, 3), (-5, 7), (None, None)]
    got = spark.createDataFrame(pairs, "a long, b long").select(tables.curve_place("a", "b")).collect()
    clipped = [[min(max(x or 0, 0), 65535) for x in pair] for pair in pairs]
    assert [r[0] for r in got] == [plain_place(*pair) for pair in clipped]


def groups_read(path, column, zones):
    """Row groups whose range holds a zone, on average over the zones."""
    held = []
    for file in pathlib.Path(path).rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        place = [meta.schema.column(i).name for i in range(len(meta.schema))].index(column)
        held += [meta.row_group(g).column(place).statistics for g in range(meta.num_row_groups)]
    return sum(sum(s.min <= z <= s.max for s in held) for z in zones) / len(zones), len(held)


def test_both_ends_skip_row_groups(spark, tmp_path):
    rows = spark.range(300_000).select(
        F.lit(dt.date(2024, 1, 1)).alias("pickup_month"), (F.pmod(F.xxhash64("id"), F.lit(256)) + 1).alias("pickup_location_id"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(256)) + 1).alias("dropoff_location_id"), F.rand(1).alias("fare_amount")).coalesce(1)
    spark.conf.set("parquet.block.size", str(64 << 10))
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", str(64 << 10))
    try:
        tables.write_clustered(rows, str(tmp_path / "curve"), rebalance=False)
        rows.sortWithinPartitions(*tables.CLUSTER_COLUMNS).write.parquet(str(tmp_path / "line"))
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
        spark.conf.unset("parquet.block.size")
    zones = range(1, 257, 5)
    pickup, groups = groups_read(tmp_path / "curve", "pickup_location_id", zones)
    dropoff, _ = groups_read(tmp_path / "curve", "dropoff_location_id", zones)
    line_dropoff, line_groups = groups_read(tmp_path / "line", "dropoff_location_id", zones)
    assert groups > 20 and line_dropoff > 0.9 * line_groups  # in linear order the second zone skips nothing
    assert dropoff < 0.4 * groups and pickup < 0.4 * groups
    assert max(pickup, dropoff) <= 2.5 * min(pickup, dropoff)
    assert spark.read.parquet(str(tmp_path / "curve")).count() == 300_000


def log(spark, path, i):
    runs.log_run(spark, path, f"run-{i}", None, "FINISHED", dt.datetime(2024, 1, 1), {"model_type": "gbt", "n": i}, {"mape": i})


def test_a_thousand_runs_are_a_handful_of_files(spark, tmp_path):
    path = tmp_path / "runs"
    log(spark, str(path), 0)
    one = next(path.glob("*.parquet"))
    for i in range(1, 999):
        (path / f"part-{i}.parquet").write_bytes(one.read_bytes())
    log(spark, str(path), 999)
    assert len(list(path.glob("*.parquet"))) == 1
    log(spark, str(path), 1000)
    assert len(list(path.glob("*.parquet"))) == 2
    table = spark.read.schema(ML_RUNS).parquet(str(path))
    assert table.count() == 1001 and {"run-0", "run-999", "run-1000"} == {r[0] for r in table.select("run_id").distinct().collect()}
    assert runs.recent_runs(table, 3).count() == 3
    assert sorted(p.name for p in tmp_path.iterdir()) == ["runs"]


def test_appends_during_a_compaction_stay(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    schema = spark.range(1).schema
    for i in range(4):
        spark.range(i, i + 1).coalesce(1).write.mode("append").parquet(path)
    listed, real = [], tables._data_files

    def late(session, folder):
        files = real(session, folder)
        if not listed:  # another job appends just after the listing
            listed.append(folder)
            session.range(100, 101).coalesce(1).write.mode("append").parquet(path)
        return files

    monkeypatch.setattr(tables, "_data_files", late)
    assert tables.compact_table(spark, path, schema) == 2
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3, 100]
    assert tables.compact_table(spark, path, schema) == 1
    assert tables.compact_table(spark, path, schema) == 1
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3, 100]


def test_contract_is_kept(spark, tmp_path):
    with pytest.raises(ValueError, match="contract"):
        tables.append_table(spark.range(1), str(tmp_path / "t"), LOAD_LOG)
