"""Building the gold tables from the stored fact."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake import schemas
from farelake.operators import gold
from farelake.operators.fact import MONTH_COLUMN
from farelake.plans.load import read_fact
from farelake.sources.state import months_of, read_state, write_state
from farelake.sources.tables import hadoop_path, replace_table, write_clustered

Maker = Callable[[DataFrame], DataFrame]

#: Rollups of the fact, stored by month: each one pass over a few columns.
ROLLUPS: dict[str, Maker] = {
    "by_day": gold.day_rollup,
    "by_vendor_payment": lambda fct: gold.clean_rollup(fct, *gold.ROLLUP_KEYS),
    "by_hour": gold.hour_rollup,
    "by_zone": lambda fct: gold.zone_rollup(fct, MONTH_COLUMN),
    "by_band": gold.band_rollup,
}

#: Gold table -> the rollup it is finished from, how, and its contract.
FINISHED: dict[str, tuple[str, Maker, T.StructType]] = {
    "daily_summary": ("by_day", gold.daily_summary_from, schemas.DAILY_SUMMARY),
    "hourly_patterns": ("by_hour", gold.hourly_patterns_from, schemas.HOURLY_PATTERNS),
    "monthly_trends": ("by_vendor_payment", gold.monthly_trends_from, schemas.MONTHLY_TRENDS),
    "location_stats": ("by_zone", gold.location_stats_from, schemas.LOCATION_STATS),
    "payment_analysis": ("by_vendor_payment", gold.payment_analysis_from, schemas.PAYMENT_ANALYSIS),
    "trip_distance_distribution": (
        "by_band", gold.trip_distance_distribution_from, schemas.TRIP_DISTANCE_DISTRIBUTION,
    ),
    "vendor_comparison": ("by_vendor_payment", gold.vendor_comparison_from, schemas.VENDOR_COMPARISON),
    "year_over_year": ("by_vendor_payment", gold.year_over_year_from, schemas.YEAR_OVER_YEAR),
}

TABLES = tuple(FINISHED)


def _month_files(spark: SparkSession, path: str, months: list[dt.date]) -> dict[dt.date, set[str]]:
    """Names of the files stored for each month."""
    held = {}
    for month in months:
        fs, folder = hadoop_path(spark, f"{path}/{MONTH_COLUMN}={month.isoformat()}")
        held[month] = {s.getPath().getName() for s in fs.listStatus(folder)} if fs.exists(folder) else set()
    return held


def _forget_unwritten(spark: SparkSession, path: str, before: dict[dt.date, set[str]]) -> None:
    """Drop the partitions that a rewrite has left as they were: those months have no rows any more."""
    for month, names in _month_files(spark, path, list(before)).items():
        if names and names == before[month]:
            fs, folder = hadoop_path(spark, f"{path}/{MONTH_COLUMN}={month.isoformat()}")
            fs.delete(folder, True)


def _rollup_path(lake: str, name: str) -> str:
    return f"{lake}/rollups/{name}"


def build_gold(
    spark: SparkSession, lake: str, months: Iterable[dt.date] | str | None = None, parallel: int = 8
) -> None:
    """Replace the eight tables under `lake`/gold.

    A pass over pruned columns of the fact fills each of five monthly rollups; the tables are
    finished from those and never touch the fact. Given the `months` a load changed, only their partitions of the fact
    are read: a daily refresh costs a month, not the history. "pending" stands for the months that loads have
    changed since the last build, as the load state knows them. A month that no longer has rows loses its rollup, and a
    full build replaces all of them. Independent jobs are submitted side by side, so the tail of one leaves no
    executor idle.
    """
    state = read_state(spark, lake)
    if isinstance(months, str):
        if months != "pending":
            raise ValueError(f"unknown months {months!r}")
        if not state.pending:
            return
        months = months_of(state.pending)
    fct = read_fact(spark, lake)
    if months is not None:
        months = list(months)
        fct = fct.filter(F.col(MONTH_COLUMN).isin(months))

    def roll_up(name: str) -> DataFrame:
        rollup = ROLLUPS[name](fct)
        if MONTH_COLUMN not in rollup.columns:
            rollup = rollup.withColumn(MONTH_COLUMN, F.trunc("pickup_date", "MM"))
        path = _rollup_path(lake, name)
        before = _month_files(spark, path, months or [])
        write_clustered(rollup, path, cluster_by=(), whole=months is None)
        _forget_unwritten(spark, path, before)
        return spark.read.schema(rollup.schema).parquet(path)

    def finish(name: str) -> None:
        source, maker, schema = FINISHED[name]
        replace_table(maker(stored[source]), f"{lake}/gold/{name}", schema)

    with ThreadPoolExecutor(parallel) as pool:
        stored = dict(zip(ROLLUPS, pool.map(roll_up, ROLLUPS)))
        list(pool.map(finish, FINISHED))
    done = state.pending if months is None else [m for m in state.pending if m in {x.isoformat() for x in months}]
    if done:
        state.pending = [m for m in state.pending if m not in done]
        write_state(spark, lake, state)


def read_rollup(spark: SparkSession, lake: str, name: str) -> DataFrame:
    """A stored rollup, from which other periods can be finished (`gold.monthly_summary_from`, for example)."""
    return spark.read.parquet(_rollup_path(lake, name))


def read_gold(spark: SparkSession, lake: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{lake}/gold/{name}") for name in TABLES}
