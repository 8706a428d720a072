"""Staging: raw trip files to typed, renamed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.functions import fixed


def _typed(df: DataFrame, raw: str, target: str) -> Column:
    column = F.col(raw)
    fractional = isinstance(df.select(raw).schema[0].dataType, (T.DoubleType, T.FloatType, T.DecimalType))
    if target == "bigint" and fractional:
        # Spark truncates a fractional value on a cast to integer; the contract rounds.
        return F.round(column).cast(target)
    return column.cast(target)


def stg_trips(bronze: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Rename and type the 19 raw columns and stamp the load time. One projection, no shuffle.

    Names resolve without regard to case, as in Spark by default, so a file that spells
    `airport_fee` differently still fits. A row's place in its file is kept if it is known.
    """
    kept = [c for c in fixed.SOURCE_COLUMNS if c in bronze.columns]
    stamp = F.current_timestamp() if loaded_at is None else loaded_at.cast("timestamp")
    return bronze.select(
        *[_typed(bronze, raw, target).alias(name) for raw, name, target in fixed.STAGING_COLUMNS],
        stamp.alias("_loaded_at"),
        *kept,
    )
