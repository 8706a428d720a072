"""Schema discovery and byte-for-byte landing: what tasks do with whole files."""

import hashlib
import pathlib

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyarrow import fs

from farelake.sources import bronze, copying, footers
from tests.frames import raw_by_month


def listed(spark, root):
    return bronze.bronze_files(spark, str(root))


def test_types_are_those_of_sparks_reader(spark, tmp_path):
    spark.sql(
        "SELECT true a, 1Y b, 2S c, 3 d, 4L e, 1.5F f, 2.5D g, 'x' h, X'00' i, date'2024-01-01' j, "
        "timestamp'2024-01-01 00:00:00' k, timestamp_ntz'2024-01-01 00:00:00' l, 1.25BD m, cast(1 as decimal(30, 4)) n"
    ).write.parquet(str(tmp_path / "spark"))
    (tmp_path / "arrow").mkdir()
    pq.write_table(pa.table({
        "u8": pa.array([1], pa.uint8()), "u16": pa.array([1], pa.uint16()), "u32": pa.array([1], pa.uint32()), "u64": pa.array([1], pa.uint64()),
        "i8": pa.array([1], pa.int8()), "i64": pa.array([1], pa.int64()), "d": pa.array([1], pa.date32()), "s": pa.array(["x"], pa.large_string()),
        "ms": pa.array([1], pa.timestamp("ms")), "us": pa.array([1], pa.timestamp("us", "UTC")), "fixed": pa.array([b"ab"], pa.binary(2)),
        "dict": pa.array(["x"]).dictionary_encode(),
    }), tmp_path / "arrow" / "a.parquet")
    (tmp_path / "old").mkdir()
    pq.write_table(pa.table({"t": pa.array([1], pa.timestamp("us"))}), tmp_path / "old" / "a.parquet", use_deprecated_int96_timestamps=True)
    for name in ("spark", "arrow", "old"):
        row = footers.footers(listed(spark, tmp_path / name)).first()
        want = spark.read.parquet(str(tmp_path / name)).schema
        assert [(c["name"], c["type"]) for c in row["columns"]] == [(f.name, f.dataType.simpleString()) for f in want]
        assert row["num_rows"] == 1 and row["file_size"] > 0


def test_nested_columns_are_refused(spark, tmp_path):
    spark.sql("SELECT array(1) AS a").write.parquet(str(tmp_path / "t"))
    with pytest.raises(Exception, match="nested columns"):
        footers.footers(listed(spark, tmp_path / "t")).collect()


def test_groups():
    plain, wide, other = [("a", "bigint")], [("A", "bigint"), ("b", "string")], [("a", "double"), ("c", "int")]
    groups = footers.agreeing_groups([(plain, ["1"]), (other, ["2"]), (wide, ["0", "3"]), ([("C", "int")], ["4"])])
    assert [(schema.simpleString(), names) for schema, names in groups] == [
        ("struct<a:bigint,b:string,C:int>", ["0", "1", "3", "4"]), ("struct<a:double,c:int>", ["2"])]


def test_many_drifted_files_are_one_job(spark, tmp_path, monkeypatch):
    """No footer is opened on the driver, and the job's number of tasks doesn't depend on how schemas differ."""
    folder = tmp_path / "lake" / "year=2024" / "month=01"
    folder.mkdir(parents=True)
    kinds = [pa.int64(), pa.float64(), pa.int32(), pa.string()]
    for i in range(400):
        columns = {"id": pa.array([i], pa.int64()), ["passenger", "Passenger"][i % 2]: pa.array([i], pa.int64()).cast(kinds[i % 4])}
        if i % 3 == 0:
            columns["fee"] = pa.array([0.5])
        pq.write_table(pa.table(columns), folder / f"{i}.parquet")

    def refuse(*_, **__):
        raise AssertionError("a footer is opened on the driver")

    monkeypatch.setattr(footers.pq, "ParquetFile", refuse)
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    context.setJobGroup("discovery", "discovery")
    try:
        files = spark.createDataFrame([(r.uri,) for r in listed(spark, tmp_path / "lake").collect()], "uri string")
        before = len(tracker.getJobIdsForGroup("discovery"))
        groups = footers.file_groups(files)
        jobs = len(tracker.getJobIdsForGroup("discovery")) - before
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)
    assert len(groups) == 4 and sum(len(names) for _, names in groups) == 400
    assert jobs <= 4  # the first file's name, and the three stages of one query
    got = bronze.bronze_scan(spark, str(tmp_path / "lake"))
    assert dict(got.dtypes) == {"id": "bigint", "passenger": "string", "fee": "double", "year": "int", "month": "int"}
    rows = {r.id: (float(r.passenger), r.fee) for r in got.collect()}
    assert rows == {i: (float(i), 0.5 if i % 3 == 0 else None) for i in range(400)}


def test_missing_columns_are_one_scan(spark, tmp_path):
    root = str(tmp_path / "lake")
    months = raw_by_month(spark).filter("year = 1996 AND month IN ('01', '02')")
    bronze.bronze_land_months(months.filter("month = '01'"), root)
    bronze.bronze_land_months(months.filter("month = '02'").drop("Airport_fee"), root)
    scan = bronze.bronze_scan(spark, root)
    plan = scan._sc._jvm.PythonSQLUtils.explainString(scan._jdf.queryExecution(), "formatted")
    assert "Union" not in plan
    assert scan.count() == months.count()
    assert scan.filter("month = 2 AND Airport_fee IS NOT NULL").count() == 0
    places = bronze.bronze_scan(spark, root, places=True).select("_source_file", "_source_row")
    assert places.distinct().count() == months.count()


def test_through_spark_where_pyarrow_cannot_read(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    bronze.bronze_land_months(raw_by_month(spark).filter("year = 1996 AND month IN ('01', '02')"), root)
    files = bronze.bronze_files(spark, root)
    want = sorted(map(tuple, footers.footers(files).select("uri", "num_rows").collect()))
    monkeypatch.setattr(footers, "_openable", lambda uri: False)
    assert sorted(map(tuple, footers.footers(files).select("uri", "num_rows").collect())) == want


def tree(folder):
    return sorted((p.name, p.read_bytes()) for p in pathlib.Path(folder).rglob("*.parquet"))


def test_landed_bytes_are_the_arrived_ones(spark, tmp_path):
    inbox, root = tmp_path / "in box", str(tmp_path / "lake")
    raw = raw_by_month(spark).filter("year = 1996 AND month = '01'").drop("year", "month")
    raw.repartition(3).write.parquet(str(inbox / "a"))
    raw.limit(0).coalesce(1).write.option("compression", "zstd").parquet(str(inbox / "b"))
    for _ in range(2):
        folder = bronze.bronze_land(spark, str(inbox), root, 1996, 1)
        assert tree(folder) == tree(inbox)
    assert sorted(p.name for p in pathlib.Path(folder).parent.iterdir()) == ["month=01"]
    assert not [p for p in pathlib.Path(folder).iterdir() if p.name.startswith("_")]
    assert bronze.bronze_scan(spark, root).count() == raw.count()


def test_equal_names_are_told_apart(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / "inbox" / name).mkdir(parents=True)
        pq.write_table(pa.table({"x": [name]}), tmp_path / "inbox" / name / "part.parquet")
    target = tmp_path / "out"
    rows = copying.copy_files(listed(spark, tmp_path / "inbox"), f"file://{target}").collect()
    assert sorted(r.name for r in rows) == ["2-part.parquet", "part.parquet"]
    for r in rows:
        content = (target / r.name).read_bytes()
        assert (len(content), hashlib.sha256(content).hexdigest()) == (r.file_size, r.sha256)
    assert {pq.read_table(target / r.name)["x"][0].as_py() for r in rows} == {"a", "b"}


class Damaging:
    """A local file system whose first `broken` copies have a byte too many."""

    def __init__(self, broken):
        self.broken, self.local = broken, fs.LocalFileSystem()

    def open_output_stream(self, path):
        stream = self.local.open_output_stream(path)
        if self.broken > 0:
            self.broken -= 1
            stream.write(b"!")
        return stream

    def __getattr__(self, name):
        return getattr(self.local, name)


def test_a_broken_copy_is_repeated(tmp_path):
    (tmp_path / "a").write_bytes(b"x" * 100_000)
    source = (fs.LocalFileSystem(), str(tmp_path / "a"))
    size, digest = copying.copy_file(source, (Damaging(2), str(tmp_path / "out")), "a")
    assert (size, digest) == (100_000, hashlib.sha256(b"x" * 100_000).hexdigest())
    assert (tmp_path / "out" / "a").read_bytes() == b"x" * 100_000
    assert not list((tmp_path / "out" / copying.UNFINISHED).iterdir())
    with pytest.raises(OSError, match="copies of"):
        copying.copy_file(source, (Damaging(9), str(tmp_path / "out")), "b")
    assert not (tmp_path / "out" / "b").exists()
