"""The trip fact table and its incremental input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.functions import fixed, trips
from farelake.schemas import FCT_TRIPS

MONTH_COLUMN = "pickup_month"


def valid_trips(stg: DataFrame) -> DataFrame:
    return stg.filter(trips.is_valid_trip())


def fct_trips(stg: DataFrame) -> DataFrame:
    """Valid trips with identity, calendar parts, measures and quality flag.

    Filter, then projections only: the whole operator is one codegen stage on top of the scan, and
    the filter reaches the Parquet reader. Trips whose key isn't known in full have no identity of their own; where
    the staged rows know their place in a file, it stands in for one.
    """
    timed = valid_trips(stg).withColumns(
        {
            "trip_id": trips.trip_id(),
            "pickup_date": F.to_date("pickup_datetime"),
            "dropoff_date": F.to_date("dropoff_datetime"),
            "pickup_hour": F.hour("pickup_datetime").cast("bigint"),
            "dropoff_hour": F.hour("dropoff_datetime").cast("bigint"),
            "pickup_day_of_week": F.dayofweek("pickup_datetime").cast("bigint"),
            "trip_duration_minutes": trips.duration_minutes(),
            "tip_percentage": trips.tip_percentage(),
        }
    )
    minutes = F.col("trip_duration_minutes")
    paced = timed.withColumn("avg_speed_mph", trips.speed_mph(minutes))
    flagged = paced.withColumn(
        "has_data_quality_issue", trips.quality_issue(minutes, F.col("avg_speed_mph"))
    )
    nameless = [F.when(F.col("trip_id").isNull(), F.col(c)).alias(c) for c in fixed.SOURCE_COLUMNS if c in stg.columns]
    return flagged.select(*FCT_TRIPS.fieldNames(), *nameless)


def with_month(fct: DataFrame) -> DataFrame:
    """Add the storage partition column, the first day of the pickup month."""
    return fct.withColumn(MONTH_COLUMN, F.trunc("pickup_date", "MM"))


def high_watermark(target: DataFrame):
    """Latest pickup time in the stored fact, or None if it is empty.

    The month column bounds the pickup time, so the maximum lies in the last month that has rows: the
    first step reads no data column at all and the second reads one column of one partition.
    """
    if MONTH_COLUMN in target.columns:
        last_month = target.agg(F.max(MONTH_COLUMN)).first()[0]
        if last_month is None:
            return None
        target = target.filter(F.col(MONTH_COLUMN) == F.lit(last_month))
    return target.agg(F.max("pickup_datetime")).first()[0]


def from_mark(stg: DataFrame, mark) -> DataFrame:
    """The staged rows at or after a pickup time; all, if it is None."""
    return stg if mark is None else stg.filter(F.col("pickup_datetime") >= F.lit(mark).cast("timestamp_ntz"))


def incremental_filter(stg: DataFrame, target: DataFrame | None, mode: str = "watermark") -> DataFrame:
    """The staged rows an incremental run has to look at.

    `watermark`: rows at or after the latest stored pickup. Rows at the maximum are read again (the
    keyed merge makes that harmless); rows of late files are never seen.
    `by_month`: every row handed in, for callers that pass only arriving months.

    The watermark is a literal in the plan rather than a joined value, so it is pushed to Parquet. It is the maximum in
    `target`, so `target` must be a table whose last load was committed whole; `load_fact` takes it from the load
    state instead.
    """
    if mode == "by_month" or target is None:
        return stg
    if mode != "watermark":
        raise ValueError(f"unknown mode {mode!r}: expected 'watermark' or 'by_month'")
    return from_mark(stg, high_watermark(target))
