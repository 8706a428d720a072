"""Exact search for the largest inner products by a dual traversal of cover trees.

Vectors are dealt to the nearest of a bounded number of pivots and from there into blocks; queries likewise into
smaller blocks. A cover tree is built over each block: a node has a centre, which is one of its vectors, and a
covering radius, and its children's centres lie apart by at least the radius divided by `BASE` and cover
the node within that distance. For a query node (centre a, radius r) and a data node (centre b, radius s), no inner
product exceeds a.b + r |b| + s |a| + r s. A pair of nodes is pruned if that is less than the worst kth score held by
any query of the group.

Each block of queries is first searched in the data block that promises most, which gives every query a kth score to
start from. Then every other data block that the same bound, taken over the whole blocks, doesn't rule out is searched, too.
Query trees travel to the data: a data tree is met by up to `GROUP` query trees at a time, and is sent once for these, so
groups are bounded whatever the data, and equal or crowded vectors are split over many blocks. Results are merged per
query. Nothing is approximate: pruning compares strictly, so ties stay.

The number of data blocks is at most `MOST_BLOCKS` (they get larger instead), so what is broadcast, a centre and two
numbers per block, is bounded.

Edge cases: vectors that are null, empty, or hold null or non-finite components take no part. Shorter vectors count as
padded with zeros. Repeated rows are candidates of their own, also for each other; a query row is never its own candidate.
Queries with fewer candidates get them all. Ties go to the smaller vec_id. Without queries the result is empty. Scores are
exact as long as they are below 2 ** 53. Other columns of the input are not looked at.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelake.llm.common import few, prepare, stored

BASE = 1.3
#: Nodes of up to so many rows aren't split: below, comparing is cheaper than bounding.
LEAF = 128
BLOCK = 4096
QUERY_BLOCK = 512
MOST_BLOCKS = 8192
#: Query blocks that meet a data block in one group, about.
GROUP = 32
#: Pivots are this many on average, at most twice as many.
MOST_PIVOTS = 256
#: Vectors compared at a time in a leaf of the queries.
BATCH = 512


def quantised(embedding: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component; null if the vector takes no part."""
    x = embedding.cast("array<double>")
    fine = F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False)) & (F.size(x) > 0)
    return F.when(fine, F.transform(x, lambda v: F.floor(v * scale)))


class Tree:
    """Cover tree over rows; every node is a range of the rows in `order`."""

    def __init__(self, points: np.ndarray):
        self.begin, self.end, self.centre, self.radius, self.children = [], [], [], [], []
        self.order = np.empty(len(points), dtype=np.int64)
        self._points, self._filled = points, 0
        todo = [(None, np.arange(len(points)), 0)]
        # Depth first, so that a node's rows are consecutive.
        while todo:
            parent, rows, centre = todo.pop()
            node = len(self.begin)
            if parent is not None:
                self.children[parent].append(node)
            far = self._distances(rows, rows[centre])
            self.begin.append(self._filled)
            self.end.append(self._filled + len(rows))
            self.centre.append(rows[centre])
            self.radius.append(float(far.max(initial=0.0)))
            self.children.append([])
            if len(rows) <= LEAF or self.radius[-1] == 0:
                self.order[self._filled:self._filled + len(rows)] = rows
                self._filled += len(rows)
                continue
            todo += [(node, rows[own], place) for own, place in self._net(rows, far, centre)]
        self.begin, self.end, self.radius = np.array(self.begin), np.array(self.end), np.array(self.radius)
        self.centres = points[self.centre]
        self.norms = np.sqrt((self.centres ** 2).sum(1))
        self.points = points[self.order]
        del self._points

    def state(self) -> dict:
        """What `restored` needs, the integral points in small types."""
        held = dict(vars(self))
        for name in ("points", "centres"):
            whole = held[name].astype(np.int64)
            for kind in (np.int16, np.int32):
                if np.array_equal(whole, whole.astype(kind)):
                    whole = whole.astype(kind)
                    break
            held[name] = whole
        return held

    @classmethod
    def restored(cls, state: dict) -> Tree:
        tree = cls.__new__(cls)
        vars(tree).update(state)
        tree.points, tree.centres = tree.points.astype(np.float64), tree.centres.astype(np.float64)
        return tree

    def _distances(self, rows: np.ndarray, centre: int) -> np.ndarray:
        return np.sqrt(((self._points[rows] - self._points[centre]) ** 2).sum(1))

    def _net(self, rows, far, centre):
        """Children: centres farthest first until all rows are covered within radius / BASE."""
        reach = far.max() / BASE
        nearest, owner, centres = far.copy(), np.zeros(len(rows), dtype=np.int64), [centre]
        while nearest.max() > reach:
            place = int(nearest.argmax())
            again = self._distances(rows, rows[place])
            closer = again < nearest
            nearest[closer], owner[closer] = again[closer], len(centres)
            centres.append(place)
        for k, place in enumerate(centres):
            own = np.flatnonzero(owner == k)
            if len(own):
                yield own, int(np.searchsorted(own, place)) if owner[place] == k else 0


class Best:
    """The k best candidates so far of each query of a tree."""

    def __init__(self, k: int, start: np.ndarray):
        n = len(start)
        self.k, self.start = k, start
        self.score = np.full((n, k), -np.inf)
        self.id = np.full((n, k), np.iinfo(np.int64).max)
        self.row = np.full((n, k), -1)

    def worst(self, begin: int, end: int) -> float:
        """A candidate below this can't be among the best of any query of the range."""
        return float(np.maximum(self.score[begin:end, -1], self.start[begin:end]).min())

    def add(self, q: slice, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        n = q.stop - q.start
        least = np.maximum(self.score[q, -1], self.start[q])
        if score.shape[1] > self.k:
            least = np.maximum(least, np.partition(score, -self.k, axis=1)[:, -self.k])
        some = np.flatnonzero((score >= least[:, None]).any(axis=0))
        if not len(some):
            return
        score, ids, rows = score[:, some], ids[some], rows[some]
        score = np.concatenate([self.score[q], score], axis=1)
        ids = np.concatenate([self.id[q], np.broadcast_to(ids, (n, len(ids)))], axis=1)
        rows = np.concatenate([self.row[q], np.broadcast_to(rows, (n, len(rows)))], axis=1)
        order = np.lexsort((rows, ids, -score), axis=1)[:, : self.k]
        for held, new in ((self.score, score), (self.id, ids), (self.row, rows)):
            held[q] = np.take_along_axis(new, order, axis=1)


def search(queries: Tree, query_rows: np.ndarray, data: Tree, data_ids: np.ndarray, data_rows: np.ndarray, k: int, start: np.ndarray) -> Best:
    """Best candidates of every query (in the order of its tree's rows) that score at least `start`."""
    best = Best(k, start)
    inner = [bool(c) for c in data.children]

    def bounds(q: int, nodes: np.ndarray) -> np.ndarray:
        a, r = queries.centres[q], queries.radius[q]
        return data.centres[nodes] @ a + r * data.norms[nodes] + data.radius[nodes] * (queries.norms[q] + r)

    def pruned(q: int, nodes: np.ndarray) -> np.ndarray:
        upper = bounds(q, nodes)
        kept = upper >= best.worst(queries.begin[q], queries.end[q]) - 1e-6 * (1 + np.abs(upper))
        return nodes[kept][np.argsort(-upper[kept], kind="stable")]

    def opened(nodes: np.ndarray) -> np.ndarray:
        return np.array([c for n in nodes for c in (data.children[n] if inner[n] else [n])], dtype=np.int64)

    todo = [(0, np.array([0]))]
    while todo:
        q, nodes = todo.pop()
        nodes = pruned(q, nodes)
        if not len(nodes):
            continue
        if queries.children[q]:
            nodes = opened(nodes)
            todo += [(c, nodes) for c in queries.children[q]]
            continue
        while any(inner[n] for n in nodes):
            nodes = pruned(q, opened(nodes))
        own = slice(int(queries.begin[q]), int(queries.end[q]))
        while len(nodes):
            sizes = np.cumsum(data.end[nodes] - data.begin[nodes])
            some = max(1, int(np.searchsorted(sizes, BATCH, side="right")))
            place = np.concatenate([np.arange(data.begin[n], data.end[n]) for n in nodes[:some]])
            score = queries.points[own] @ data.points[place].T
            rows = data_rows[data.order[place]]
            score[(query_rows[queries.order[own]][:, None] == rows) | (score < start[own][:, None])] = -np.inf
            best.add(own, score, data_ids[data.order[place]], rows)
            nodes = pruned(q, nodes[some:]) if some < len(nodes) else nodes[:0]
    return best


def _placed(batches: Iterator[pa.RecordBatch], pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    dims = pivots.shape[1]
    squares = (pivots ** 2).sum(1)
    for batch in batches:
        x = _matrix(batch["v"].to_pylist(), dims)
        cell = np.argmin(squares - 2 * x @ pivots.T, axis=1) if len(x) else np.array([], dtype=np.int64)
        yield pa.record_batch({"row": batch["row"], "cell": pa.array(cell, pa.int64())})


def _matrix(vectors: list[list[int]], dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims))
    for place, v in enumerate(vectors):
        out[place, : len(v)] = v
    return out


def _planted(table: pa.Table, dims: int) -> pa.Table:
    """One row per block: its tree and ids, and what bounds it."""
    tree = Tree(_matrix(table["v"].to_pylist(), dims))
    held = pickle.dumps((tree.state(), table["row"].to_numpy(), table["vec_id"].to_numpy()))
    return pa.table({
        "block": table["block"][:1], "n": pa.array([len(tree.order)], pa.int64()), "centre": pa.array([tree.centres[0]], pa.list_(pa.float64())),
        "radius": pa.array([tree.radius[0]]), "tree": pa.array([held], pa.binary())})


def _blocks(vectors: DataFrame, cells: DataFrame, size: int, dims: int) -> DataFrame:
    counts = cells.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / size).alias("cuts"))
    block = F.concat_ws("-", "cell", F.pmod(F.xxhash64("row"), F.col("cuts")))
    rows = vectors.join(cells.join(counts, "cell").select("row", block.alias("block")), "row")
    return rows.groupBy("block").applyInArrow(
        lambda t: _planted(t, dims), "block string, n long, centre array<double>, radius double, tree binary")


def _pairs(batches: Iterator[pa.RecordBatch], data, first: bool, k: int) -> Iterator[pa.RecordBatch]:
    """Pairs of blocks to search: for each query block the most promising one, or all others that its bound leaves."""
    names, centres, radii, sizes = data.value
    norms = np.sqrt((centres ** 2).sum(1))
    for batch in batches:
        left, right = [], []
        for block, centre, radius, worst in zip(*(batch[c].to_pylist() for c in ("block", "centre", "radius", "worst"))):
            a = np.array(centre)
            # enough vectors to give a kth score, if there is such a block
            best = int(np.argmax(np.where(sizes > k, centres @ a, -np.inf)))
            take = [best]
            if not first:
                upper = centres @ a + radius * norms + radii * (math.sqrt(a @ a) + radius)
                take = [i for i in np.flatnonzero(upper >= worst - 1e-6 * (1 + np.abs(upper))).tolist() if i != best]
            left += [block] * len(take)
            right += [names[i] for i in take]
        yield pa.record_batch({"q": pa.array(left, pa.string()), "d": pa.array(right, pa.string())})


def _searched(asked: pa.Table, planted: pa.Table, k: int) -> pa.Table:
    """What the query blocks of a group find in its data block."""
    out = []
    for tree in planted["d_tree"].to_pylist():
        data, d_rows, d_ids = pickle.loads(tree)
        data = Tree.restored(data)
        for q, q_tree, start_rows, starts in zip(*(asked[c].to_pylist() for c in ("q", "q_tree", "rows", "starts"))):
            queries, q_rows, q_ids = pickle.loads(q_tree)
            queries = Tree.restored(queries)
            known = dict(zip(start_rows or [], starts or []))
            start = np.array([known.get(r, -np.inf) for r in q_rows[queries.order].tolist()])
            best = search(queries, q_rows, data, d_ids, d_rows, k, start)
            x, y = np.nonzero((best.row >= 0) & (best.score > -np.inf))
            out.append(pa.table({
                "q": pa.array([q] * len(x), pa.string()), "row": q_rows[queries.order[x]], "query_id": q_ids[queries.order[x]],
                "vec_id": best.id[x, y], "d_row": best.row[x, y], "score": best.score[x, y].astype(np.int64)}))
    names = ("row", "query_id", "vec_id", "d_row", "score")
    schema = pa.schema([("q", pa.string()), *((c, pa.int64()) for c in names)])
    return pa.concat_tables(out) if out else schema.empty_table()


def top_k(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best of `vectors` (vec_id long, v array<long>, null if without part)."""
    spark = prepare(vectors.sparkSession)
    rows = stored(
        vectors.withColumn("q", F.coalesce(is_query, F.lit(False))).select("vec_id", "v", "q").where("v is not null")
        .withColumn("row", F.monotonically_increasing_id()), "vectors")
    count, dims = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    size = max(BLOCK, math.ceil(2 * count / MOST_BLOCKS))
    some = few(rows.select("row", "v"), min(MOST_PIVOTS, max(1, count // size)), "row")
    pivots = _matrix([r["v"] for r in some], dims) if some else np.zeros((1, dims))
    cells = stored(rows.select("row", "v").mapInArrow(partial(_placed, pivots=pivots), "row long, cell long"), "cells")
    data = stored(_blocks(rows.select("row", "vec_id", "v"), cells, size, dims), "data")
    queries = rows.where("q").select("row", "vec_id", "v")
    of_queries = cells.join(queries.select("row"), "row", "left_semi")
    asked = stored(_blocks(queries, of_queries, QUERY_BLOCK, dims), "asked")
    known = data.select("block", "n", "centre", "radius").orderBy("block").collect()  # at most MOST_BLOCKS and one per pivot
    if not known:
        known_parts = ([], np.zeros((0, dims)), np.zeros(0), np.zeros(0))
    else:
        known_parts = ([r["block"] for r in known], np.array([r["centre"] for r in known]), np.array([r["radius"] for r in known]), np.array([r["n"] for r in known]))
    bounded = spark.sparkContext.broadcast(known_parts)

    parts = max(1, math.ceil(asked.count() / GROUP))

    def found(starts: DataFrame | None) -> DataFrame:
        heads = asked.select(F.col("block").alias("q"), "block", "centre", "radius", F.col("tree").alias("q_tree"))
        if starts is None:
            heads = heads.withColumns({
                "rows": F.lit(None).cast("array<long>"), "starts": F.lit(None).cast("array<double>"), "worst": F.lit(None).cast("double")})
        else:
            heads = heads.join(starts, "q", "left")
        heads = heads.withColumn("worst", F.coalesce("worst", F.lit(float("-inf"))))
        pairs = heads.select("block", "centre", "radius", "worst").mapInArrow(
            partial(_pairs, data=bounded, first=starts is None, k=k), "q string, d string")
        pairs = pairs.withColumn("part", F.pmod(F.xxhash64("q"), F.lit(parts)))
        sent = pairs.join(heads.select("q", "q_tree", "rows", "starts"), "q").groupBy("d", "part")
        met = data.select(F.col("block").alias("d"), F.col("tree").alias("d_tree")).join(
            pairs.select("d", "part").distinct(), "d").select(F.col("d").alias("of"), F.col("part").alias("of_part"), "d_tree").groupBy("of", "of_part")
        return sent.cogroup(met).applyInArrow(
            lambda q, d: _searched(q, d, k), "q string, row long, query_id long, vec_id long, d_row long, score long")

    first = stored(found(None), "first")
    kth = first.groupBy("q", "row").agg(F.count(F.lit(1)).alias("n"), F.min("score").cast("double").alias("score")).where(F.col("n") == k)
    # Queries without k candidates so far have no entry, and their block no worst score.
    starts = kth.groupBy("q").agg(F.collect_list("row").alias("rows"), F.collect_list("score").alias("starts"), F.min("score").alias("worst"), F.count(F.lit(1)).alias("m"))
    full = asked.select(F.col("block").alias("q"), F.col("n").alias("of"))
    starts = stored(starts.join(full, "q").select("q", "rows", "starts", F.when(F.col("m") == F.col("of"), F.col("worst")).alias("worst")), "starts")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id", "d_row"))
    return first.unionByName(found(starts)).withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
