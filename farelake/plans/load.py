"""The trip load: raw lake to fact, dimensions and quality report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake import schemas
from farelake.functions.fixed import SOURCE_COLUMNS
from farelake.operators import dims, dq
from farelake.operators.fact import MONTH_COLUMN, fct_trips, from_mark, high_watermark, with_month
from farelake.operators.merge import merge_partitioned, resolve_duplicates
from farelake.operators.staging import stg_trips
from farelake.sources.bronze import bronze_scan, month_files
from farelake.sources.state import months_of, new_files, read_state, record_files, write_state
from farelake.sources.tables import path_exists, replace_table, write_clustered


def fact_path(lake: str) -> str:
    return f"{lake}/fct_trips"


FACT_SCHEMA = T.StructType([
    *schemas.FCT_TRIPS.fields,
    *(T.StructField(name, T.LongType()) for name in SOURCE_COLUMNS),  # of trips without an identity
    T.StructField(MONTH_COLUMN, T.DateType()),
])


def read_fact(spark: SparkSession, lake: str) -> DataFrame:
    return spark.read.schema(FACT_SCHEMA).parquet(fact_path(lake))


def arriving_files(
    spark: SparkSession, bronze_root: str, lake: str, months: Iterable[tuple[int, int]] | None = None
) -> DataFrame:
    """The raw files that no committed load has taken in, or all files of `months`."""
    if months is not None:
        return month_files(spark, bronze_root, months)
    return new_files(spark, lake, month_files(spark, bronze_root), read_state(spark, lake))


def load_fact(
    spark: SparkSession,
    bronze_root: str,
    lake: str,
    mode: str = "watermark",
    months: Iterable[tuple[int, int]] | None = None,
    on_duplicate: str = "error",
    files: DataFrame | None = None,
) -> list | None:
    """Bring the fact up to date; returns the months that changed, or None for a first load.

    Only `files` (`arriving_files`, if None) are read. `watermark` takes their trips from the latest pickup that a
    committed load stored; rows from there on in older files were loaded with those files. `by_month` takes the files of
    `months` (all, if None) whatever is stored, so late months load. The first load writes each file's rows
    where they were read, sorted by zone, without a shuffle; later ones merge by trip identity.

    The load counts once its state is written. One that dies earlier is repeated by the next call: a first load starts
    over, a later one merges the same files again from the same watermark. Trips without an identity are then known by their
    place in a file.
    """
    if mode not in ("watermark", "by_month"):
        raise ValueError(f"unknown mode {mode!r}: expected 'watermark' or 'by_month'")
    path, state = fact_path(lake), read_state(spark, lake)
    if files is None:
        months = list(months) if months is not None else None
        by_month = month_files(spark, bronze_root, months) if mode == "by_month" else None
        files = by_month if by_month is not None else arriving_files(spark, bronze_root, lake)
    arriving = files.select("uri", "file_size", "modified").collect()  # names, not contents
    if not arriving:
        if not state.loads or mode == "by_month":
            raise ValueError(f"no Parquet files under {bronze_root}" + (" for the given months" if months else ""))
        return []
    files = spark.createDataFrame(arriving, files.select("uri", "file_size", "modified").schema)
    bronze = bronze_scan(spark, bronze_root, files=[row.uri for row in arriving], places=True)
    first = not state.loads and (state.started or not path_exists(spark, path))
    mark = state.mark() if mode == "watermark" else None
    fct = with_month(fct_trips(from_mark(stg_trips(bronze), mark)))
    if first:
        state.started = True
        state = write_state(spark, lake, state)
        rows = resolve_duplicates(None, fct, ["trip_id"], on_duplicate, ["_loaded_at"])
        seen = Observation("first load")  # the watermark comes from the write itself, not from reading it back
        write_clustered(rows.observe(seen, F.max("pickup_datetime").alias("newest")), path, rebalance=rows is not fct, whole=True)
        newest, changed = seen.get["newest"], None
    else:
        changed = merge_partitioned(
            spark, path, fct, ["trip_id"], MONTH_COLUMN, on_duplicate=on_duplicate, newest=["_loaded_at"],
            stand_in=SOURCE_COLUMNS, settled=True,
        )
        newest = high_watermark(read_fact(spark, lake))
    load = record_files(lake, files)
    state.watermark = newest.isoformat() if newest else None
    state.loads = [*state.loads, load]
    state.note_changes(changed)
    write_state(spark, lake, state)
    return changed


def load_dimensions(spark: SparkSession, bronze: DataFrame, lake: str, grow: bool = False) -> None:
    """Rebuild the five dimensions side by side; each code dimension reads one raw column.

    With `grow`, `bronze` holds new files only, and the codes that are stored stay.
    """
    staged = stg_trips(bronze)

    def codes(name: str, table: DataFrame, schema: T.StructType) -> tuple[str, DataFrame, T.StructType]:
        if grow and path_exists(spark, f"{lake}/{name}"):
            table = table.unionByName(spark.read.schema(schema).parquet(f"{lake}/{name}")).distinct()
        return name, table, schema

    tables = (
        codes("dim_vendor", dims.dim_vendor(staged), schemas.DIM_VENDOR),
        codes("dim_payment_type", dims.dim_payment_type(staged), schemas.DIM_PAYMENT_TYPE),
        codes("dim_rate_code", dims.dim_rate_code(staged), schemas.DIM_RATE_CODE),
        ("dim_date", dims.dim_date(spark), schemas.DIM_DATE),
        ("dim_time", dims.dim_time(spark), schemas.DIM_TIME),
    )
    with ThreadPoolExecutor(len(tables)) as pool:
        jobs = [pool.submit(replace_table, table, f"{lake}/{name}", schema) for name, table, schema in tables]
        for job in jobs:
            job.result()


def check_quality(spark: SparkSession, lake: str, months: Iterable[dt.date] | str | None = None) -> DataFrame:
    """Report of all declared checks over the stored tables, stored under `lake`/dq_report.

    The fact's results are kept by month, and a month's keys lie in no other month: only `months` are looked at, and the
    report adds up what is stored. None stands for all, "pending" for those that loads changed since they were checked.
    """
    state = read_state(spark, lake)
    if isinstance(months, str):
        if months != "pending":
            raise ValueError(f"unknown months {months!r}")
        months = months_of(state.unchecked)
    months = None if months is None else list(months)
    path, checks = f"{lake}/checks/fct_trips", dq.DECLARED_CHECKS["fct_trips"]
    if months is None or months:
        fct = read_fact(spark, lake)
        fct = fct if months is None else fct.filter(F.col(MONTH_COLUMN).isin(months))
        found = dq.checks_by(fct, MONTH_COLUMN, checks)
        if months is not None and path_exists(spark, path):
            stored = spark.read.schema(found.schema).parquet(path)
            found = found.unionByName(stored.filter(~F.col(MONTH_COLUMN).isin(months)))
        replace_table(found, path)
    parts = [dq.added_up("fct_trips", spark.read.parquet(path), checks)]
    for name in dq.DECLARED_CHECKS:
        if name != "fct_trips":
            parts += dq.table_report(name, spark.read.parquet(f"{lake}/{name}"), dq.DECLARED_CHECKS[name])
    report = replace_table(dq.judged(parts), f"{lake}/dq_report")
    done = state.unchecked if months is None else [m for m in state.unchecked if m in {x.isoformat() for x in months}]
    if done:
        state.unchecked = [m for m in state.unchecked if m not in done]
        write_state(spark, lake, state)
    return report


def load_trips(spark: SparkSession, bronze_root: str, lake: str, **fact_options) -> DataFrame:
    """Dimensions, fact, checks; raises if a check of severity `error` fails. Reads the files that arrived only."""
    months = fact_options.get("months")
    by_month = fact_options.get("mode") == "by_month"
    files = month_files(spark, bronze_root, months) if by_month else arriving_files(spark, bronze_root, lake)
    names = [row.uri for row in files.select("uri").collect()]
    if names:
        load_dimensions(spark, bronze_scan(spark, bronze_root, files=names), lake, grow=bool(read_state(spark, lake).loads))
    load_fact(spark, bronze_root, lake, **fact_options)
    return dq.require_passing(check_quality(spark, lake, "pending"))
