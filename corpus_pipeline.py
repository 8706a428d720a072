"""From raw documents to packed batches: quality rules, near copies, source mix, packing.

A stage takes the documents its predecessor kept and returns documents; the last returns the batches. Between
stages the documents are a Parquet table, so a stage can be run again by itself. A stage begins by having the driver give
back what the one before took, so that memory doesn't add up over a session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farelake.llm import jaccard, mixing, packing, quality
from farelake.llm.common import collected, prepare, stored, table

#: The cutoffs come from a statistical test and the mix from its outcome: no SQL. The tests hold every stage
#: against a plain version.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the proven cutoffs."""
    collected(spark)
    return quality.quality_filter(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least doc_id."""
    collected(spark)
    return jaccard.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for."""
    collected(spark)
    return mixing.mixed_documents(docs)


def packing_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and place of every document."""
    collected(spark)
    return packing.packed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("source_mix", source_mix),
    ("packing", packing_batches),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(prepare(spark), docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
