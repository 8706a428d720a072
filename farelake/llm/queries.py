"""The operators over their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm import (
    chat, extraction, jaccard, language, mixing, packing, ppm, quality, spelling, topk, trie, urls, warc,
)
from farelake.llm.common import prepare, table

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    _REGISTRY[fn.__name__] = run
    return fn


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


@query
def op10_ngram_jaccard_join(spark, sf_dir):
    return jaccard.near_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op5_quality_rules(spark, sf_dir):
    return quality.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_source_mixing(spark, sf_dir):
    return mixing.mixed_words(table(spark, sf_dir, "documents"))


@query
def op2_packing(spark, sf_dir):
    return packing.packed(table(spark, sf_dir, "documents"))


@query
def op6_chat_formatting(spark, sf_dir):
    marks = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame(
        [(-7, 0, "user", marks), (-7, 1, "assistant", marks)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.chat_digests(chat.chat_examples(turns))


@query
def op8_url_filters(spark, sf_dir):
    return urls.url_verdicts(table(spark, sf_dir, "pages"))


@query
def op4_warc(spark, sf_dir):
    return warc.archived_and_read(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op1_html_extraction(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    scores = extraction.fit_scores(extraction.labelled_pages(pages, table(spark, sf_dir, "documents")))
    return extraction.extracted_pages(pages, scores)


@query
def op7_lm_scoring(spark, sf_dir):
    return ppm.scored(table(spark, sf_dir, "documents"))


@query
def op9_exact_top_k(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", topk.quantised(F.col("embedding")).alias("v"))
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0)


@query
def op11_language_id(spark, sf_dir):
    return language.identified(table(spark, sf_dir, "documents"))


@query
def op12_conversation_trie(spark, sf_dir):
    turns = trie.ordered_turns(table(spark, sf_dir, "conversations"))
    return trie.prefix_trie(trie.with_shared_openings(turns, family=20, most=4))


@query
def op13_spelling_variants(spark, sf_dir):
    return spelling.variants(spelling.counted_words(table(spark, sf_dir, "documents")))
