"""Connected components of an undirected graph, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm.common import stored


def _starred(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step over edges (u, v), u > v.

    larger: every node hands the least node of its neighbourhood to its larger neighbours; else to its
    smaller ones and itself. Both keep the components and shorten paths.
    """
    if larger:
        edges = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    paired = edges.join(least, "u")
    if larger:
        out = paired.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = paired.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return out.where("u > v").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node with an edge; the component is its least node.

    Large and small star steps alternate until nothing changes, which takes about the square of the
    logarithm of the longest path. Only pairs of numbers move. A hub of many edges is met by a minimum
    (combined before the shuffle) and by a join whose large keys Spark splits. Null ends are ignored.
    """
    now = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    now = stored(now, "edges")
    seen = None
    while True:
        state = now.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
        if tuple(state) == seen or not state[0]:
            break
        seen = tuple(state)
        now = stored(_starred(_starred(now, larger=True), larger=False), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
