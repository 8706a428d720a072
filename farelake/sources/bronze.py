"""The raw lake: one folder per month of Parquet files, `year=YYYY/month=MM`."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.functions import fixed
from farelake.schemas import LOAD_LOG
from farelake.sources.copying import UNFINISHED, copy_files
from farelake.sources.footers import file_groups, footers
from farelake.sources.tables import append_table, hadoop_path, path_exists, repair_table

#: The raw columns as published, for readers that cannot look at the files first (streams).
RAW_TRIPS = T.StructType(
    [
        T.StructField("VendorID", T.LongType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.LongType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("PULocationID", T.LongType()),
        T.StructField("DOLocationID", T.LongType()),
        T.StructField("RatecodeID", T.LongType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("payment_type", T.LongType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("Airport_fee", T.DoubleType()),
    ]
)


def month_folder(root: str, year: int, month: int) -> str:
    return f"{root.rstrip('/')}/year={year}/month={month:02d}"


def bronze_land(spark: SparkSession, inbox: str, root: str, year: int, month: int) -> str:
    """Put one month's raw files in its folder, byte for byte as they came.

    Tasks copy the files and read the copies back. Replaces what the month held, so a repeated load is harmless;
    other months are not touched.
    """
    folder = month_folder(root, year, month)
    files = bronze_files(spark, inbox).select("uri")
    if files.isEmpty():
        raise ValueError(f"no Parquet files under {inbox}")
    repair_table(spark, folder)
    fs, target = hadoop_path(spark, folder)
    incoming, outgoing = f"{folder}__next-{uuid.uuid4().hex[:12]}", f"{folder}__old-{uuid.uuid4().hex[:12]}"
    _, new = hadoop_path(spark, incoming)
    fs.mkdirs(new)
    copy_files(files, fs.makeQualified(new).toUri().toString()).select("name").collect()
    _, unfinished = hadoop_path(spark, f"{incoming}/{UNFINISHED}")
    fs.delete(unfinished, True)
    had_old = fs.exists(target)
    _, old = hadoop_path(spark, outgoing)
    if had_old and not fs.rename(target, old):
        raise OSError(f"could not move {folder} aside")
    if not fs.rename(new, target):
        if had_old:
            fs.rename(old, target)
        raise OSError(f"could not move the new files to {folder}")
    if had_old:
        fs.delete(old, True)
    return folder


def bronze_land_months(raw: DataFrame, root: str) -> None:
    """The same for many months at once; `raw` carries the files' `year` and `month` ('MM').

    Months are rebalanced, not hashed to one task each: a month with a third of all rows is written
    by many tasks.
    """
    (
        raw.hint("rebalance", "year", "month")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month")
        .parquet(root)
    )


def bronze_files(spark: SparkSession, root: str) -> DataFrame:
    """(uri, folder, file_size, modified) of every Parquet file under the root. Contents are not read."""
    if not path_exists(spark, root):
        raise ValueError(f"no such folder: {root}")
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(root)
    )
    uri = F.col("_metadata.file_path")
    return listing.select(
        uri.alias("uri"),
        F.regexp_replace(uri, "/[^/]+$", "").alias("folder"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def month_files(spark: SparkSession, root: str, months: Iterable[tuple[int, int]] | None = None) -> DataFrame:
    """`bronze_files` of the given months; of all, if None."""
    listed = bronze_files(spark, root)
    if months is None:
        return listed
    endings = [month_folder("", year, month) for year, month in months]
    name = F.concat(F.lit("/"), F.regexp_extract("folder", r"year=[^/]+/month=[^/]+$", 0))
    return listed.filter(name.isin(endings))


def _common_type(kinds: set[T.DataType]) -> T.DataType:
    if len(kinds) == 1:
        return next(iter(kinds))
    if all(isinstance(kind, T.NumericType) for kind in kinds):
        whole = all(isinstance(kind, T.IntegralType) for kind in kinds)
        return T.LongType() if whole else T.DoubleType()
    if kinds <= {T.TimestampType(), T.TimestampNTZType()}:
        return T.TimestampNTZType()
    return T.StringType()


def bronze_scan(
    spark: SparkSession,
    root: str,
    months: Iterable[tuple[int, int]] | None = None,
    files: list[str] | None = None,
    places: bool = False,
) -> DataFrame:
    """All raw files (or those of `months`, or `files`) as one table, whatever types each file used.

    One job reads all footers. Files whose types agree are one plain scan, whatever columns they lack. Otherwise
    each group that agrees (a handful, however many files there are) is cast to the common types, and the groups are
    unioned. Names are matched without regard to case. `year` and `month` come from the folder names and prune the scan. With `places`, each row
    has its file and its number there as `fixed.SOURCE_COLUMNS`.
    """
    listed = month_files(spark, root, months) if files is None else spark.createDataFrame(
        [(uri,) for uri in files], "uri string")
    groups = file_groups(listed)
    if not groups:
        raise ValueError(f"no Parquet files under {root}" + (" for the given months" if months else ""))

    def read(schema: T.StructType, names: list[str]) -> DataFrame:
        if files is None and len(groups) == 1:  # whole folders, so their files needn't be looked up one by one
            names = sorted({name.rsplit("/", 1)[0] for name in names})
        part = spark.read.schema(schema).option("basePath", root).parquet(*names)
        if not places:
            return part
        place = (F.xxhash64("_metadata.file_path"), F.col("_metadata.row_index"))
        return part.select("*", *(column.alias(name) for column, name in zip(place, fixed.SOURCE_COLUMNS)))

    if len(groups) == 1:
        return read(*groups[0])
    spelling: dict[str, str] = {}
    kinds: dict[str, set[T.DataType]] = {}
    for schema, _ in groups:
        for field in schema:
            spelling.setdefault(field.name.lower(), field.name)
            kinds.setdefault(field.name.lower(), set()).add(field.dataType)

    def cast(schema: T.StructType, names: list[str]) -> DataFrame:
        part = read(schema, names)
        columns = [
            F.col(field.name).cast(_common_type(kinds[field.name.lower()])).alias(spelling[field.name.lower()])
            for field in schema
        ]
        partitions = [c for c in part.columns if c.lower() not in kinds]
        return part.select(*columns, *partitions)

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [cast(*group) for group in groups])


def bronze_validate(
    spark: SparkSession, root: str, expected: Iterable[tuple[int, int]] = ()
) -> DataFrame:
    """One row per file: month, size, rows and the columns of its month. A file without rows is listed with 0.

    All of it comes from the listing and the footers, which one job reads. Raises if an expected (year, month) has no file.
    """
    listed = bronze_files(spark, root)
    present = {row.folder.replace("%3D", "=") for row in listed.select("folder").distinct().collect()}
    if not present:
        raise ValueError(f"no Parquet files under {root}")
    missing = [
        (year, month)
        for year, month in expected
        if not any(folder.endswith(month_folder("", year, month)) for folder in present)
    ]
    if missing:
        raise ValueError(f"no file for {', '.join(f'{y}-{m:02d}' for y, m in missing)} under {root}")
    names = F.transform("columns", lambda c: F.lower(c["name"]))
    per_folder = footers(listed.select("uri", "folder", "file_size")).groupBy("folder").agg(
        F.collect_list(F.struct("uri", "file_size", "num_rows")).alias("files"),
        F.size(F.array_distinct(F.flatten(F.collect_set(names)))).alias("num_columns"),
    )
    part = F.regexp_extract
    return per_folder.select("folder", "num_columns", F.inline("files")).select(
        part("folder", r"year=(\d+)", 1).cast("bigint").alias("year"),
        part("folder", r"month=(\d+)", 1).cast("bigint").alias("month"),
        "uri",
        "folder",
        "file_size",
        "num_rows",
        F.col("num_columns").cast("bigint").alias("num_columns"),
    )


def bronze_metrics(validated: DataFrame) -> DataFrame:
    """One load-log record per month."""
    return (
        validated.groupBy("year", "month", F.col("folder").alias("uri"))
        .agg(
            F.round(F.sum("file_size") / F.lit(1024.0 * 1024.0), 2).alias("file_size_mb"),
            F.sum("num_rows").alias("num_rows"),
            F.max("num_columns").alias("num_columns"),
        )
        .withColumn("logged_at", F.current_timestamp())
    )


def log_load(validated: DataFrame, path: str) -> None:
    append_table(bronze_metrics(validated), path, LOAD_LOG)
