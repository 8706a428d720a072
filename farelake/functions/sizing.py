"""Deciding when a join side is small enough to copy to every executor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A broadcast side stays below this many bytes.
BROADCAST_MAX_BYTES = 64 << 20


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """`df` marked for broadcast if the planner knows it to be at most `max_bytes` large, otherwise unchanged.

    Nothing is run. For a stored table the planner knows the size of its files; for a derived frame it assumes the
    size of its input, so a small frame derived from a large one should be stored first. Beyond the bound the
    join stays a shuffled one, with AQE splitting its hot keys.
    """
    known = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return F.broadcast(df) if int(str(known)) <= max_bytes else df
