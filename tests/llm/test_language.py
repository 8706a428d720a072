"""Language identification: features and gradients against plain versions, accuracy on held-out documents, edge cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelake.llm import language

WORDS = {"aa": ["the", "and", "shop", "thing"], "bb": ["ñandú", "año", "ciudad", "llave"]}


def plain_grams(text):
    """Buckets of the grams of a text, one word at a time."""
    found, word = [], ""
    for c in text.lower() + " ":
        if c.isalpha():
            word += c
            continue
        marked = [0, *map(ord, word), 0] if word else []
        for length in range(language.LEAST_GRAM, language.MOST_GRAM + 1):
            for i in range(len(marked) - length + 1):
                value = 0
                for code in marked[i:i + length]:
                    value = (value * 0x100000001B3 + code) % (1 << 64)
                found.append(((value + length) * 0x9E3779B97F4A7C15 % (1 << 64)) >> (64 - language.BITS))
        word = ""
    return found


TEXTS = ["Hello, World", "", "ab", "x", "12 34", "Ça va? Ñandú-ﬁ", "é" * 200_000 + " end", "a b\nc\t𝒜𝒷 \x00z"]


@pytest.mark.parametrize("text", TEXTS)
def test_grams(text):
    want = np.bincount(plain_grams(text), minlength=1 << language.BITS) if plain_grams(text) else np.zeros(1 << language.BITS)
    assert (language.gram_counts(text) == want).all()


def test_scores_of_many_texts_are_those_of_one():
    rng = np.random.default_rng(1)
    model = language.Model(("a", "b", "c"), rng.normal(size=(1 << language.BITS, 3)), np.array([0.1, 0, -0.1]), 1.5, 0.4)
    odds, counts = language.log_odds(TEXTS, model)
    for text, got, n in zip(TEXTS, odds, counts):
        grams = plain_grams(text)
        assert n == len(grams)
        assert np.allclose(got, model.bias + (model.table[grams].mean(axis=0) if grams else 0))


def documents(spark, n=240):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(WORDS[lang], rng.integers(3, 30))), lang, i) for i in range(n) for lang in [("aa", "bb")[i % 2]]]
    rows += [(1000, None, "aa", 0), (1001, "", "bb", 0), (1002, "123 --", "aa", 0), (1003, "the thing", None, 0)]
    rows += [(None, "the and", "aa", 0), (0, rows[0][1], "aa", 0), (1004, "the shop " * 50_000, "aa", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, key long"), rows


def test_whole_table(spark):
    docs, rows = documents(spark)
    got = language.identified(docs)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score", "rejected"]
    found = got.collect()
    assert len(found) == len(rows)
    for r in found:
        assert r["held_out"] == (zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
    by_id = {r["doc_id"]: r for r in found}
    for i in (1000, 1001, 1002):
        assert (by_id[i]["lang_pred"], by_id[i]["score"], by_id[i]["rejected"]) == ("und", 0.0, True)
    right = [by_id[i]["lang_pred"] == lang for i, text, lang, _ in rows if lang and i is not None and i < 1000]
    assert all(right)
    assert by_id[1003]["lang_pred"] == by_id[1004]["lang_pred"] == "aa"


def test_only_taught_rows_teach(spark):
    """Neither the held out third nor a lang that only it has is learned, and lang isn't an input."""
    docs, _ = documents(spark)
    model = language.fitted(docs)
    changed = docs.withColumn("lang", F.when(language.held_out(), F.lit("zz")).otherwise(F.col("lang")))
    other = language.fitted(changed)
    assert other.languages == model.languages == ("aa", "bb")
    assert np.array_equal(other.table, model.table)
    hidden = docs.withColumn("lang", F.lit(None).cast("string"))
    same = language.identified(docs, model).select("doc_id", "lang_pred", "score")
    assert same.exceptAll(language.identified(hidden, model).select(*same.columns)).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identified(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    right = sum(r["lang"] == r["lang_pred"] for r in got)
    assert right >= 0.98 * len(got)
    accepted = [r for r in got if not r["rejected"]]
    assert sum(r["lang"] != r["lang_pred"] for r in accepted) <= 0.02 * len(accepted)
    assert abs(sum(r["score"] for r in got) / len(got) - right / len(got)) < 0.05  # calibrated


def test_sample_is_shared_and_bounded(spark):
    rows = [(i, f"text {i % 7} word{i}", "many", 0) for i in range(3000)] + [(i, "rare text", "few", 0) for i in range(3000, 3010)]
    rows += [(5, "copied", "many", 0)] * 2000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, key long")
    got = language.sampled(docs, most=200).groupBy("lang").count().collect()
    sizes = {r["lang"]: r["count"] for r in got}
    assert sizes["few"] >= 5 and 20 <= sizes["many"] <= 160


def test_nothing_to_learn(spark):
    schema = "doc_id long, text string, lang string"
    assert language.identified(spark.createDataFrame([], schema)).count() == 0
    row = language.identified(spark.createDataFrame([(1, "some text", None)], schema)).first()
    assert (row["lang_pred"], row["score"], row["rejected"]) == ("und", 0.0, True)
    one = language.identified(spark.createDataFrame([(1, "some text", "aa"), (3, "more text", "aa")], schema)).first()
    assert one["lang_pred"] == "aa"
