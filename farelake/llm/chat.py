"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and the text of that one
reply is all that is trained on. A conversation that doesn't end with an assistant turn also gives one
example without a target, so that the output holds every turn.

A turn is written as <|role|>role<|text|>text<|end|>. Inside roles and texts, a backslash follows the first
character of every control string and every backslash is doubled, so control strings in texts can't be
mistaken for marks and reading back gives the very text.

Everything is built-in DataFrame functions. The turns of a conversation meet in one row; the expansion happens inside
the task that holds it.

Edge cases: null texts and roles are empty. Turns are in the order of turn (null first), then role, then text; repeated
rows are turns of their own. Rows without conv_id are one conversation. Without assistant turns there is only the
example without a target. An empty table gives no rows. Other columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.llm.common import prepare

ROLE, TEXT, END = "<|role|>", "<|text|>", "<|end|>"
#: Strings that mean something to this or other common templates. "<|" covers this template's own marks.
CONTROL = ["<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
TRAINED = "assistant"


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def chat_examples(turns: DataFrame) -> DataFrame:
    """(conv_id, example, formatted, loss_start, loss_length, whole) of conversations (conv_id, turn, role, text).

    loss_start, loss_length: the span of `formatted` that is trained on, in code points from 0; null without a
    target. whole: the example holds all turns of its conversation.
    """
    prepare(turns.sparkSession)
    text, role = (F.coalesce(c, F.lit("")) for c in ("text", "role"))
    grouped = turns.select("conv_id", F.struct("turn", role.alias("role"), text.alias("text")).alias("t")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list("t")).alias("t"))
    written = grouped.select("conv_id", F.transform("t", lambda t: F.struct(
        F.concat(F.lit(ROLE), escaped(t["role"]), F.lit(TEXT)).alias("head"),
        escaped(t["text"]).alias("body"), (t["role"] == TRAINED).alias("trained"))).alias("t"))
    size = F.size("t")
    places = F.filter(F.sequence(F.lit(1), size), lambda i: F.element_at("t", i)["trained"] | (i == size))
    placed = written.select("conv_id", "t", F.posexplode(places).alias("example", "place"))
    last = F.element_at("t", F.col("place"))
    context = F.array_join(F.transform(
        F.slice("t", F.lit(1), F.col("place") - 1), lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    return placed.select(
        "conv_id", F.col("example").cast("long").alias("example"), F.concat(context, last["head"]).alias("before"),
        last["body"].alias("body"), last["trained"].alias("trained"), (F.col("place") == size).alias("whole"),
    ).select(
        "conv_id", "example", F.concat("before", "body", F.lit(END)).alias("formatted"),
        F.when(F.col("trained"), F.length("before").cast("long")).alias("loss_start"),
        F.when(F.col("trained"), F.length("body").cast("long")).alias("loss_length"), "whole")


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) that a formatted text was made from."""
    parts = F.split(formatted, r"<\|end\|>")
    turns = F.slice(parts, F.lit(1), F.size(parts) - 1)  # what follows the last mark is empty
    return F.transform(turns, lambda t: F.struct(
        unescaped(F.substring_index(F.substr(t, F.lit(len(ROLE) + 1)), TEXT, 1)).alias("role"),
        unescaped(F.substr(t, F.lit(len(ROLE) + len(TEXT) + 1) + F.length(
            F.substring_index(F.substr(t, F.lit(len(ROLE) + 1)), TEXT, 1)))).alias("text")))


def chat_digests(examples: DataFrame) -> DataFrame:
    """What the examples of each conversation say, read back from their formatted texts."""
    trained = unescaped(F.substr("formatted", F.col("loss_start").cast("int") + 1, F.col("loss_length").cast("int")))
    turns = F.when(F.col("whole"), read_turns(F.col("formatted")))
    said = F.sha2(F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256)
    each = examples.select(
        "conv_id", F.length("formatted").cast("long").alias("chars"), F.size(turns).cast("long").alias("n"), said.alias("said"),
        F.when(F.col("loss_start").isNotNull(), F.struct("example", trained.alias("text"))).alias("trained"))
    texts = F.array_join(F.transform(F.array_sort("trained"), lambda t: t["text"]), "")
    return each.groupBy("conv_id").agg(
        F.max("n").alias("n_turns"), F.max("said").alias("turns_sha256"), F.collect_list("trained").alias("trained"),
        F.sum("chars").alias("formatted_chars"),
    ).select(
        "conv_id", "n_turns", "turns_sha256", F.length(texts).cast("long").alias("loss_chars"),
        F.sha2(texts, 256).alias("loss_sha256"), "formatted_chars")
