"""Daily exchange rates: the XML feed, JSON records and the keyed rate table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.functions import fixed
from farelake.operators.merge import duplicate_keys, merge_partitioned, resolve_duplicates, upsert
from farelake.schemas import FX_RATES
from farelake.sources.tables import path_exists

KEYS = ("quote_currency", "run_date")

_RATE = T.DecimalType(18, 6)
_QUOTES = T.ArrayType(T.StructType([T.StructField("_currency", T.StringType()), T.StructField("_rate", _RATE)]))
_DAYS = T.ArrayType(T.StructType([T.StructField("_time", T.StringType()), T.StructField("Cube", _QUOTES)]))
_ENVELOPE = T.StructType([T.StructField("Cube", T.StructType([T.StructField("Cube", _DAYS)]))])
_RECORDS = "array<struct<base:string,quote:string,rate:decimal(18,6)>>"


def fx_extract(
    spark: SparkSession, path: str, base: str = fixed.FX_BASE, row_tag: str = "gesmes:Envelope"
) -> DataFrame:
    """(feed_date, base, quote, rate) of every day of every envelope under `path`."""
    envelopes = spark.read.format("xml").option("rowTag", row_tag).schema(_ENVELOPE).load(path)
    days = envelopes.select(F.explode("Cube.Cube").alias("day"))
    quotes = days.select(F.to_date("day._time").alias("feed_date"), F.explode("day.Cube").alias("cube"))
    return quotes.select(
        "feed_date",
        F.lit(base).alias("base"),
        F.col("cube._currency").alias("quote"),
        F.col("cube._rate").alias("rate"),
    )


def fx_records(df: DataFrame, column: str) -> DataFrame:
    """Rates from a column of JSON record arrays."""
    return df.select(F.inline(F.from_json(column, _RECORDS)))


def as_rows(rates: DataFrame, run_date) -> DataFrame:
    """Table rows of a load. `run_date` is the date of the run, not the date inside the feed: a weekend
    run stores Friday's rates under its own date."""
    day = run_date if not isinstance(run_date, dt.date) else F.lit(run_date)
    return rates.select(
        F.col("base").alias("base_currency"),
        F.col("quote").alias("quote_currency"),
        F.col("rate").cast(_RATE).alias("rate"),
        day.cast("date").alias("run_date"),
    )


def fx_upsert(target: DataFrame, rates: DataFrame, run_date, on_duplicate: str = "error_any") -> DataFrame:
    """The rate table with a run's rates put in: rate and base of a known (quote, date) are replaced."""
    rows = resolve_duplicates(target, as_rows(rates, run_date), KEYS, on_duplicate)
    return upsert(target, rows, KEYS)


def fx_table(spark: SparkSession, path: str) -> DataFrame:
    """The stored table, created empty if there is none; its key must be unique."""
    if not path_exists(spark, path):
        spark.createDataFrame([], FX_RATES).write.partitionBy("run_date").parquet(path)
    table = spark.read.schema(FX_RATES).parquet(path)
    broken = duplicate_keys(table, KEYS).limit(1).collect()
    if broken:
        raise ValueError(f"rate table holds a key twice: {tuple(broken[0])}")
    return table


def fx_load(
    spark: SparkSession, path: str, rates: DataFrame, run_date, on_duplicate: str = "error_any"
) -> None:
    """Upsert a run into the stored table; only its date's folder is rewritten."""
    merge_partitioned(
        spark,
        path,
        as_rows(rates, run_date),
        KEYS,
        "run_date",
        cluster_by=("quote_currency",),
        on_duplicate=on_duplicate,
    )
