"""The source mix against a word-by-word version."""

import hashlib
import random

import pytest

from farelake.llm import mixing


def plain_targets(sizes):
    """By the rule as stated: share by weight, stop at the cap, share the excess among the rest, again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    capped, total = {}, sum(sizes.values())
    while True:
        rest = [s for s in names if s not in capped]
        left, w = total - sum(capped.values()), sum(weight[s] for s in rest)
        over = [s for s in rest if left * weight[s] / w > 3 * sizes[s]]
        if not over:
            return capped | {s: left * weight[s] / w for s in rest}
        capped |= {s: 3.0 * sizes[s] for s in over}


def plain_mix(rows):
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    targets, out = plain_targets(sizes), []
    for source in sizes:
        own = [(hashlib.md5(f"{mixing.SEED}{'' if d is None else d}:{t or ''}".encode()).hexdigest(), -1 if d is None else d, len((t or "").split()))
               for d, s, t in rows if s == source]
        start, filled = 0, round(targets[source])
        for _, d, n in sorted(own):
            taken = sum(p * sizes[source] + start <= x < p * sizes[source] + start + n for p in range(3)
                        for x in range(min(filled, p * sizes[source] + start), min(filled, p * sizes[source] + start + n)))
            out.append((None if d == -1 else d, n, sizes[source], targets[source], taken))
            start += n
    return out


def table(spark, seed=1, n=60):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["a", "a", "a", "B", "é", None, "tiny"] if i else ["tiny"]), " ".join("w" for _ in range(rng.randrange(90)))) for i in range(n)]
    rows = [(d, s, t if s != "tiny" else "w w w") for d, s, t in rows]
    rows += [(100, "a", None), (101, "none", ""), (5, *rows[5][1:]), (None, "a", "x y z"), (102, "long", "w " * 20000)]
    return rows, spark.createDataFrame([(*r, "en", 1) for r in rows], "doc_id long, source string, text string, lang string, size int")


@pytest.mark.parametrize("block,slice_rows", [(7, 50_000), (64, 9), (256, 50_000)])
def test_like_plain(spark, monkeypatch, block, slice_rows):
    monkeypatch.setattr(mixing, "SLICE_ROWS", slice_rows)
    monkeypatch.setattr(mixing, "SLOTS_OF_CHUNK", 64)
    rows, docs = table(spark)
    got = sorted(map(tuple, mixing.mixed_words(docs, block).collect()), key=str)
    want = sorted(plain_mix(rows), key=str)
    assert [(g[0], g[1], g[2], g[4]) for g in got] == [(w[0], w[1], w[2], w[4]) for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want])
    assert all(g[4] <= 3 * g[1] for g in got)
    assert all((g[5] is None) == (g[4] == 0) for g in got)


def test_schedule_is_even(spark):
    """In any stretch of the mix the sources are near their shares; every needed block has one slot."""
    rows, docs = table(spark, n=300)
    sized = mixing.sizes(docs)
    mix = mixing.targets(sized).cache()
    share = {r["source_no"]: r["target"] for r in mix.collect()}
    total = sum(share.values())
    slots = sorted(map(tuple, mixing.schedule(mix, 16).select("slot", "source_no", "block_no").collect()))
    assert [s for s, _, _ in slots] == sorted({s for s, _, _ in slots})
    for no, target in share.items():
        blocks = sorted(b for _, s, b in slots if s == no)
        assert blocks == list(range(-(-round(target) // 16)))
        seen = 0
        for place, (_, s, _) in enumerate(slots):
            seen += s == no
            assert abs(seen - (place + 1) * target / total) < 8


def test_documents(spark):
    rows, docs = table(spark)
    taken = {}
    for d, n, _, _, t in plain_mix(rows):
        taken.setdefault((d, n), []).append(t)
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    copies = {}
    for r in got.collect():
        key = (r["doc_id"], len((r["text"] or "").split()))
        copies[key] = copies.get(key, 0) + 1
    for (d, n), t in taken.items():
        whole = sum(x // n + (2 * (x % n) >= n and x % n > 0) if n else 0 for x in t)
        assert copies.get((d, n), 0) == whole


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.mixed_words(empty).count() == 0
    assert mixing.mixed_documents(empty).count() == 0
    blank = spark.createDataFrame([(1, "a", None), (2, None, " ")], "doc_id long, source string, text string")
    assert sorted(map(tuple, mixing.mixed_words(blank).collect())) == [(1, 0, 0, 0.0, 0, None), (2, 0, 0, 0.0, 0, None)]


def unevenness(got, share, total):
    """How far the words of a source, in the order of slots, are at most from its share of all words so far."""
    seen, words, most = dict.fromkeys(share, 0), 0, 0.0
    for _, source, n in sorted(got):
        seen[source] += n
        words += n
        most = max(most, *(abs(seen[s] - words * share[s] / total) for s in share))
    return most


def test_order_of_the_mix_is_the_schedule(spark, monkeypatch):
    """Any stretch from the start has the sources near their weights, and only by the schedule."""
    rng = random.Random(2)
    rows = [(i, rng.choice("aab"), " ".join("w" for _ in range(rng.randrange(5, 15)))) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    share = plain_targets(sizes)
    total = sum(share.values())

    def mixed():
        got = mixing.mixed_documents(docs, block=16, slot="slot")
        assert got.columns == [*docs.columns, "slot"]
        return [(r["slot"], r["source"], len(r["text"].split())) for r in got.collect()]

    assert unevenness(mixed(), share, total) < 4 * 16

    def one_after_the_other(mix, block):
        blocks = mix.where("target > 0").selectExpr("source_no", f"explode(sequence(0L, cast(ceil(round(target) / {block}) as bigint) - 1)) as block_no")
        return blocks.selectExpr("row_number() over (order by source_no, block_no) - 1 as slot", "source_no", "block_no")

    monkeypatch.setattr(mixing, "schedule", one_after_the_other)
    assert unevenness(mixed(), share, total) > 1000


def test_no_value_is_lost_and_names_may_clash(spark):
    rows = [(1, "a", "x y z", "p", 1, 2), (1, "a", "x y z", "q", 1, 2), (None, "a", "u v w", None, 3, 4), (None, "a", "u v w", None, 3, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, `a.note` string, _row int, slot int")
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(rows, key=str)


def test_rows_without_doc_id_spread(spark):
    docs = spark.range(2000).selectExpr("cast(null as long) as doc_id", "'a' as source", "concat('w', id) as text")
    slices = mixing.sizes(docs).select(mixing.slice_of(mixing.F.col("key"), 20).alias("s")).distinct().count()
    assert slices == 20
