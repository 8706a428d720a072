"""Exact top k against all pairs, and the trees' invariants."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelake.llm import topk


def vectors(seed, n=400, dims=6):
    rng = np.random.default_rng(seed)
    x = rng.integers(-40, 40, (n, dims)) + 30 * rng.integers(-2, 3, (n, 1))
    x[n // 2:n // 2 + n // 4] = x[0]  # a quarter are equal
    return x


@pytest.mark.parametrize("seed", range(3))
def test_tree(seed):
    x = vectors(seed).astype(float)
    tree = topk.Tree(x)
    assert sorted(tree.order.tolist()) == list(range(len(x)))
    for node, children in enumerate(tree.children):
        own = tree.points[tree.begin[node]:tree.end[node]]
        far = np.sqrt(((own - tree.centres[node]) ** 2).sum(1))
        assert far.max() <= tree.radius[node] + 1e-9
        assert (far == 0).any()  # the centre is one of the rows
        if children:
            assert [tree.begin[children[0]]] + [tree.end[c] for c in children] == [tree.begin[node]] + [tree.begin[c] for c in children[1:]] + [tree.end[node]]
            centres = tree.centres[children]
            gaps = np.sqrt(((centres[:, None] - centres) ** 2).sum(2)) + 1e9 * np.eye(len(children))
            assert gaps.min() >= tree.radius[node] / topk.BASE - 1e-9
            assert max(tree.radius[c] for c in children) <= tree.radius[node] / topk.BASE + 1e-9
    again = topk.Tree.restored(tree.state())
    assert (again.points == tree.points).all() and again.points.dtype == float


def plain(rows, k):
    dims = max(len(v) for _, v in rows)
    x = np.array([list(v) + [0] * (dims - len(v)) for _, v in rows])
    scores, out = x @ x.T, []
    for i, (q, _) in enumerate(rows):
        if q is not None and q % 5 == 0:
            order = sorted((-int(scores[i, j]), (rows[j][0] is not None, rows[j][0] or 0)) for j in range(len(rows)) if j != i)[:k]
            out += [(q, place + 1, v[1] if v[0] else None, -s) for place, (s, v) in enumerate(order)]
    return sorted(out, key=str)


@pytest.mark.parametrize("n,k,block,query_block", [(400, 20, 64, 16), (400, 7, 4096, 512), (9, 20, 4, 2), (300, 1, 32, 8)])
def test_like_all_pairs(spark, monkeypatch, n, k, block, query_block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", query_block)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(n, n))]
    rows += [rows[5], (5000, [1, 2])]
    df = spark.createDataFrame([(*r, 9) for r in rows] + [(77, None, 9)], "vec_id long, v array<long>, score int")
    got = topk.top_k(df, F.col("vec_id") % 5 == 0, k)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows, k)


def test_quantised(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.01]), (1, None), (2, [1.0, None]), (3, [nan]), (4, [inf]), (5, [-inf, 1.0]), (6, []), (7, [1 / 3])]
    df = spark.createDataFrame(rows, "i int, e array<float>")
    got = {r["i"]: r["v"] for r in df.select("i", topk.quantised(F.col("e")).alias("v")).collect()}
    assert got == {0: [32, -1], 1: None, 2: None, 3: None, 4: None, 5: None, 6: None, 7: [21]}


def test_empty(spark):
    none = spark.createDataFrame([], "vec_id long, v array<long>")
    assert topk.top_k(none, F.lit(True)).count() == 0
    one = spark.createDataFrame([(1, [3])], "vec_id long, v array<long>")
    assert topk.top_k(one, F.lit(True)).count() == 0
    assert topk.top_k(one, F.lit(False)).count() == 0
