"""Packing documents into token-budget batches of similar length.

All documents of a bucket are padded to its upper bound. Dynamic programming over the histogram of all lengths
chooses the bounds of `buckets` buckets so that the padding over the whole table is least. Inside a
bucket, documents in shuffled order form batches of as many rows as fit the budget of padded tokens.

The histogram is exact for lengths up to 64 and has 64 cells per doubling above, at most about
64 * 60 rows whatever the input; each cell counts with its largest length. The bounds are optimal among the
cells' largest lengths. Ranks inside a bucket go by slices, so that a bucket with most of the rows is many
tasks; only slice counts meet in one.

Edge cases: a null text has length 0. A document longer than the budget is a batch of its own and is not cut.
Repeated rows are packed each. An empty table gives no rows. Other columns of the input are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelake.llm.common import cell, prepare, stored, words
from farelake.llm.mixing import SLICE_ROWS, shuffle_key, slice_of

BUCKETS = 8
#: Padded tokens of a batch.
BUDGET = 16_384


def bucket_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most `buckets` buckets with the least sum of counts times bound.

    lengths: ascending, distinct. best[j] is the least cost of the first j lengths with the buckets used so far.
    """
    n = len(lengths)
    if not n:
        return []
    below = np.r_[0.0, np.cumsum(counts, dtype=np.float64)]
    best = np.r_[0.0, np.full(n, np.inf)]
    cuts = []
    for _ in range(min(buckets, n)):
        now, cut = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=np.int64)
        now[0] = 0.0
        for j in range(1, n + 1):
            cost = best[:j] + (below[j] - below[:j]) * float(lengths[j - 1])
            cut[j] = int(np.argmin(cost))
            now[j] = cost[cut[j]]
        best = now
        cuts.append(cut)
    bounds, j = [], n
    for cut in reversed(cuts):
        if j:
            bounds.append(int(lengths[j - 1]))
            j = int(cut[j])
    return bounds[::-1]


def packed(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """(doc_id, n_tokens, bucket, bucket_length, batch, place) of every row of `docs` (doc_id, text).

    Tokens are words. bucket counts from 0, batch within its bucket, place within its batch.
    """
    prepare(docs.sparkSession)
    sized = stored(docs.select(
        "doc_id", F.size(words(F.col("text"))).cast("long").alias("n_tokens"),
        shuffle_key(F.col("doc_id"), F.col("text")).alias("_key")), "lengths")
    cells = sized.groupBy(cell(F.col("n_tokens")).alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), F.max("n_tokens").alias("length")).orderBy("length").collect()
    bounds = bucket_bounds(np.array([r["length"] for r in cells]), np.array([r["n"] for r in cells]), buckets)
    slices = max(1, math.ceil(sum(r["n"] for r in cells) / SLICE_ROWS))
    bucket = sum((F.when(F.col("n_tokens") > b, 1).otherwise(0) for b in bounds), F.lit(0))
    length = F.get(F.array(*map(F.lit, bounds or [0])).cast("array<bigint>"), F.col("bucket"))
    rows = sized.withColumns({"bucket": bucket}).withColumns({
        "bucket_length": length, "_slice": slice_of(F.col("_key"), slices)})
    ahead = Window.partitionBy("bucket").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("bucket", "_slice").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_ahead", F.coalesce(F.sum("_n").over(ahead), F.lit(0))).drop("_n")
    inside = Window.partitionBy("bucket", "_slice").orderBy("_key", "doc_id", "n_tokens")
    rank = F.col("_ahead") + F.col("_rank") - 1
    room = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(budget) / F.greatest("bucket_length", F.lit(1))))
    return (
        rows.withColumn("_rank", F.row_number().over(inside)).join(offsets, ["bucket", "_slice"])
        .select("doc_id", "n_tokens", "bucket", "bucket_length", F.floor(rank / room).alias("batch"), (rank % room).alias("place"))
    )
