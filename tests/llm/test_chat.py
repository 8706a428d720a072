"""Chat examples: masks and exact reading back."""

import hashlib
import random

from pyspark.sql import functions as F

from farelake.llm import chat


def conversations():
    rng = random.Random(6)
    bits = [*chat.CONTROL, "\\", "<", "|", "a", "é😀", "\n", "<|end|>", "<|role|>", "[", " ", "\\\\<", "$1"]
    text = lambda: "".join(rng.choice(bits) for _ in range(rng.randrange(12)))
    rows = []
    for conv in range(40):
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "assistant", "system", "<|text|>", None]), text() if rng.random() < 0.9 else None))
    rows += [rows[3], (None, 0, "user", "x"), (None, None, "assistant", "y"), (99, 5, "assistant", "long " * 50_000), (98, 0, "user", None)]
    return rows


def test_reads_back(spark):
    rows = conversations()
    turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    examples = chat.chat_examples(turns)
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    found = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in found.items()}
    got = {r["conv_id"]: r for r in chat.chat_digests(examples).collect()}
    chars = {}
    for r in examples.select("conv_id", "example", "formatted", "loss_start", "loss_length", "whole", chat.read_turns(F.col("formatted")).alias("turns")).collect():
        turns_of = [tuple(t) for t in r["turns"]]
        own = found[r["conv_id"]]
        assert turns_of == own[: len(turns_of)]
        assert r["whole"] == (len(turns_of) == len(own))
        chars[r["conv_id"]] = chars.get(r["conv_id"], 0) + len(r["formatted"])
        if turns_of[-1][0] == "assistant":
            end = r["loss_start"] + r["loss_length"]
            assert r["formatted"][end:] == chat.END and r["formatted"][:r["loss_start"]].endswith(chat.ROLE + "assistant" + chat.TEXT)
        else:
            assert r["loss_start"] is None and r["whole"]
    assert examples.count() == sum(sum(r == "assistant" for r, _ in x) + (x[-1][0] != "assistant") for x in found.values())
    for conv, own in found.items():
        loss = "".join(t for r, t in own if r == "assistant")
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert tuple(got[conv]) == (conv, len(own), sha("".join(f"{r}\n{t}\n" for r, t in own)), len(loss), sha(loss), chars[conv])
    assert len(got) == len(found)


def test_empty(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.chat_digests(chat.chat_examples(none)).count() == 0
