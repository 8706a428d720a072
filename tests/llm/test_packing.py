"""Bucket bounds against all choices, and the batches."""

import itertools
import random

import numpy as np
import pytest

from farelake.llm import packing


@pytest.mark.parametrize("seed", range(20))
def test_bounds_are_optimal(seed):
    rng = random.Random(seed)
    lengths = sorted(rng.sample(range(40), rng.randrange(1, 10)))
    counts = [rng.randrange(1, 9) for _ in lengths]
    k = rng.randrange(1, 5)

    def cost(bounds):
        return sum(n * next(b for b in bounds if b >= x) for x, n in zip(lengths, counts))

    best = min(cost([*c, lengths[-1]]) for m in range(min(k, len(lengths))) for c in itertools.combinations(lengths[:-1], m))
    got = packing.bucket_bounds(np.array(lengths), np.array(counts), k)
    assert len(got) <= k and got == sorted(got) and cost(got) == best


@pytest.mark.parametrize("slice_rows", [50_000, 20])
def test_batches(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(packing, "SLICE_ROWS", slice_rows)
    rng = random.Random(2)
    rows = [(i, " ".join("w" * rng.randrange(1, 5) for _ in range(int(rng.expovariate(0.02)))), 1) for i in range(500)]
    rows += [(900, None, 1), (901, "", 1), (3, rows[3][1], 1), (None, "a b", 1), (902, "w " * 5000, 1)]
    got = packing.packed(spark.createDataFrame(rows, "doc_id long, text string, bucket int"), buckets=4, budget=600).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"]) for r in got) == sorted(
        (d is None, d or 0, len((t or "").split())) for d, t, _ in rows)
    bounds = {r["bucket"]: r["bucket_length"] for r in got}
    assert sorted(bounds) == list(range(len(bounds))) and len(bounds) <= 4
    for r in got:
        assert r["n_tokens"] <= r["bucket_length"] and (not r["bucket"] or r["n_tokens"] > bounds[r["bucket"] - 1])
    for bucket, length in bounds.items():
        room = max(1, 600 // max(length, 1))
        places = sorted((r["batch"], r["place"]) for r in got if r["bucket"] == bucket)
        assert places == [(i // room, i % room) for i in range(len(places))]


def test_empty(spark):
    assert packing.packed(spark.createDataFrame([], "doc_id long, text string")).count() == 0
