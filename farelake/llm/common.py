"""Helpers shared by the operators of this package."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from farelake.session import scratch_path, ship

#: White space that separates words: blank, tab, line feed, vertical tab, form feed, carriage return.
#: bytes.split() separates at exactly these.
SPACE = r"[\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Rows of an Arrow batch. Texts can be megabytes long, so a batch must not hold many.
ARROW_ROWS = 512


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on; all of them can be changed on a running session."""
    ship()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written once to the shared scratch folder and read back.

    It cuts the lineage in a way that survives lost executors, and what is read twice is computed once.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def collected(spark: SparkSession) -> SparkSession:
    """Has the driver's JVM collect its garbage now, which gives memory back that finished jobs took.

    Spark drops their shuffles and broadcasts only when the collector has found them unused, and a heap that grew under
    a burst of small jobs stays as large. Called between the steps of a job that plans many of them.
    """
    spark._jvm.System.gc()
    return spark


def words(text: Column) -> Column:
    """Array of the words of a text; empty for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Cells per doubling of `cell`; numbers up to it have cells of their own.
FINE = 64


def cell(number: Column) -> Column:
    """A number that `number` shares with those of nearly its size; at most FINE * 60 different ones. Never decreases."""
    step = F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(number, F.lit(FINE)) / F.lit(FINE))))
    return (F.ceil(number / step) * step).cast("long")


def least_cell(df: DataFrame, count: str, most: int) -> int | None:
    """The least `cell` of `count` with at most `most` rows in it and above; None if there is none."""
    cells = df.groupBy(cell(F.col(count)).alias("c")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("c")).collect()
    least, held = None, 0
    for row in cells:
        held += row["n"]
        if held > most:
            break
        least = row["c"]
    return least


def most_frequent(df: DataFrame, count: str, most: int) -> DataFrame:
    """The rows with the largest values of `count`, at most `most` of them; rows of one cell stay together."""
    least = least_cell(df, count, most)
    return df.where(F.lit(False) if least is None else cell(F.col(count)) >= least)


def few(df: DataFrame, most: int, *keys: str) -> list[Row]:
    """About `most` rows, and at most twice as many, picked by a hash of `keys`; all rows if there are fewer."""
    share = math.ceil((1 << 32) * min(1.0, most / max(df.count(), 1)))
    return df.where(F.pmod(F.xxhash64(*keys), F.lit(1 << 32)) < share).limit(2 * most).collect()
