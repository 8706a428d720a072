"""Prefix trie of conversations by a splitter-skeleton.

A conversation is the path of its turns, a turn being its role and text. Every distinct opening of a conversation is
a node, from the root without turns. The trie is never in one place:

1. A turn becomes a digest of 16 bytes, a conversation one row: its path, the digests one after the other. In
   the order of (path, conv_id) the members of every node lie together.
2. A sample of the rows gives splitters, each cut to the turn that tells it from the sample before it; where a
   path is so frequent that two samples share it, the conv_id splits it. Splitters cut the rows into shards.
3. Only a node with a splitter beneath it can have members in two shards. These nodes are the skeleton: the
   trie of the splitters' paths, which is broadcast. Everything else is finished inside one sorted shard, in one pass
   that keeps a path and the finished children of its nodes.
4. For a skeleton node every shard gives a partial aggregate. They are reduced by node; then sums over
   subtrees and parents are taken within the skeleton, which is known on the driver.

Bounds: a sample has `SAMPLED` rows a shard, there are at most `MOST_SHARDS` shards, and the skeleton has at most a node
per shard and turn that two neighbours in the sample share. A conversation is one row of 20 bytes a turn. A frequent path
lies in as many shards as its members need. The digest of its members is by definition computed one after
the other: one task streams their decimal ids, `CHUNK_IDS` to a row.

Edge cases: null role and text are empty, turns are ordered by turn (null first) and then by digest, repeated
rows are repeated turns. Rows without conv_id belong to no conversation. An empty table has no node. Other columns
of the input are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm.common import prepare, stored, words

#: Bytes of a turn's digest.
DIGEST = 16
SHARD_ROWS = 50_000
MOST_SHARDS = 8192
SAMPLED = 16
CHUNK_IDS = 4096

#: A boundary without conv_id comes before all rows of its path.
_FIRST = -(1 << 63)
_NODE, _PART, _IDS = 0, 1, 2
_OUT = ("kind int, node long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends string, words long, shard int, chunk int")
_ARROW = pa.schema([
    ("kind", pa.int32()), ("node", pa.int64()), ("conv_id", pa.int64()), ("depth", pa.int64()),
    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
    ("saved_tokens", pa.int64()), ("ends", pa.string()), ("words", pa.int64()), ("shard", pa.int32()),
    ("chunk", pa.int32()),
])

Skeleton = dict[tuple[int, bytes], int]
Boundary = tuple[bytes, int]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): per conversation an array of (digest as hex, words of the text), in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * DIGEST)
    turn = F.struct(
        F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"), digest.alias("digest"),
        F.size(words(text)).alias("words"))
    return conversations.where("conv_id IS NOT NULL").select("conv_id", turn.alias("t")).groupBy("conv_id").agg(
        F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))
                    ).alias("turns"))


def with_shared_openings(turns: DataFrame, family: int, most: int) -> DataFrame:
    """Conversations c whose first crc32(c) % most turns are those of conversation c - c % family."""
    heads = turns.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("head"), F.slice("turns", 1, most - 1).alias("opening"))
    taken = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    joined = turns.join(heads, F.col("conv_id") - F.col("conv_id") % family == F.col("head"), "left")
    opening = F.slice(F.coalesce("opening", F.slice("turns", 1, 0)), F.lit(1), taken)
    rest = F.slice("turns", taken + 1, F.greatest(F.size("turns"), F.lit(1)))
    return joined.select("conv_id", F.concat(opening, rest).alias("turns"))


def _shared(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common."""
    least = min(len(a), len(b)) // DIGEST
    low, high = 0, least
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle * DIGEST] == b[:middle * DIGEST] else (low, middle - 1)
    return low


def boundaries(sample: list[Boundary], shards: int) -> list[Boundary]:
    """Rows from which a new shard begins, from a sample of (path, conv_id)."""
    sample = sorted(sample)
    found = []
    for k in range(1, shards):
        i = k * len(sample) // shards
        if not i:
            continue
        (before, _), (path, conv_id) = sample[i - 1], sample[i]
        cut = (path, conv_id) if path == before else (path[:(_shared(before, path) + 1) * DIGEST], _FIRST)
        if not found or cut > found[-1]:
            found.append(cut)
    return found


def skeleton(cuts: list[Boundary]) -> Skeleton:
    """Numbers of all nodes but the root, by (parent's number, digest), that a boundary lies beneath. The root is 0."""
    nodes: Skeleton = {}
    for path, conv_id in cuts:
        at = 0
        for i in range(len(path) // DIGEST - (conv_id == _FIRST)):
            at = nodes.setdefault((at, path[i * DIGEST:(i + 1) * DIGEST]), len(nodes) + 1)
    return nodes


class _Frame:
    """A node whose members are still being read."""

    __slots__ = ("number", "digest", "words", "least", "n", "children", "leaves", "saved", "ends", "ids", "chunk", "waiting")

    def __init__(self, number: int | None, digest: bytes, n_words: int):
        self.number, self.digest, self.words = number, digest, n_words
        self.least, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends, self.ids, self.chunk, self.waiting = None, [], 0, []


class _Shard:
    """One pass over the sorted rows of a shard; what is finished is in `out`."""

    def __init__(self, shard: int, nodes: Skeleton):
        self.shard, self.nodes, self.out = shard, nodes, []
        self.path, self.stack = b"", [_Frame(0, b"", 0)]

    def add(self, conv_id: int, path: bytes, n_words: list[int]) -> None:
        same = _shared(self.path, path)
        while len(self.stack) > same + 1:
            self._pop()
        for i in range(same, len(path) // DIGEST):
            digest, above = path[i * DIGEST:(i + 1) * DIGEST], self.stack[-1].number
            number = None if above is None else self.nodes.get((above, digest))
            self.stack.append(_Frame(number, digest, n_words[i]))
        self.path, top = path, self.stack[-1]
        top.n += 1
        top.least = conv_id if top.least is None else min(top.least, conv_id)
        if top.number is None:
            top.ends = top.ends or hashlib.sha256()
            top.ends.update(b"%d" % conv_id if top.n == 1 else b",%d" % conv_id)
        else:
            top.ids.append(conv_id)
            if len(top.ids) == CHUNK_IDS:
                self._ids(top)

    def close(self) -> list[tuple]:
        while self.stack:
            self._pop()
        return self.out

    def _ids(self, frame: _Frame) -> None:
        if frame.ids:
            text = ",".join(map(str, frame.ids))
            self.out.append((_IDS, frame.number, *[None] * 7, text, None, self.shard, frame.chunk))
            frame.ids, frame.chunk = [], frame.chunk + 1

    def _pop(self) -> None:
        frame, depth = self.stack.pop(), len(self.stack)
        above = self.stack[-1] if self.stack else None
        if frame.number is not None:
            saved = frame.saved + frame.n * frame.words
            self._ids(frame)
            if frame.n:
                self.out.append((_PART, frame.number, frame.least, depth, None, frame.n, frame.children, frame.leaves,
                                 saved, None, frame.words, self.shard, None))
        else:
            saved = frame.saved + (frame.n - 1) * frame.words
            frame.leaves += not frame.children
            self.out += [(*row[:4], frame.least, *row[5:]) for row in frame.waiting]
            row = (_NODE, above.number, frame.least, depth, None, frame.n, frame.children, frame.leaves, saved,
                   (frame.ends or hashlib.sha256()).hexdigest(), None, None, None)
            (self.out if above.number is not None else above.waiting).append(row)
            above.children += 1
        if above and frame.n:
            above.n += frame.n
            above.least = frame.least if above.least is None else min(above.least, frame.least)
            above.leaves += frame.leaves
            above.saved += saved


def _dealt(batches: Iterator[pa.RecordBatch], cuts: list[Boundary]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = zip(batch["path"].to_pylist(), batch["conv_id"].to_pylist())
        shards = [bisect_right(cuts, key) for key in keys]
        yield pa.record_batch([*batch.columns, pa.array(shards, pa.int32())], [*batch.schema.names, "shard"])


def _rows(found: list[tuple]) -> pa.RecordBatch:
    columns = zip(*found) if found else [[]] * len(_ARROW)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def _finished(batches: Iterator[pa.RecordBatch], nodes: Skeleton) -> Iterator[pa.RecordBatch]:
    now = None
    for batch in batches:
        for shard, conv_id, path, n_words in zip(*(batch[c].to_pylist() for c in ("shard", "conv_id", "path", "words"))):
            if now is None or now.shard != shard:
                if now:
                    yield _rows(now.close())
                now = _Shard(shard, nodes)
            now.add(conv_id, path, n_words)
            if len(now.out) >= CHUNK_IDS:
                yield _rows(now.out)
                now.out = []
    if now:
        yield _rows(now.close())


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's ids, whose chunks come in order."""
    node, state = None, None
    for batch in batches:
        for at, ids in zip(batch["node"].to_pylist(), batch["ends"].to_pylist()):
            if at == node:
                state.update(b",")
            else:
                if state:
                    yield pa.record_batch({"node": pa.array([node], pa.int64()), "ends": pa.array([state.hexdigest()])})
                node, state = at, hashlib.sha256()
            state.update(ids.encode())
    if state:
        yield pa.record_batch({"node": pa.array([node], pa.int64()), "ends": pa.array([state.hexdigest()])})


def _reduced(found: DataFrame, nodes: Skeleton, partitions: int) -> list[tuple]:
    """(number, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends) of skeleton nodes."""
    parts = found.where(F.col("kind") == _PART).groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("words").alias("words"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"))).collect()
    ends = found.where(F.col("kind") == _IDS).select("node", "shard", "chunk", "ends").repartition(
        partitions, "node").sortWithinPartitions("node", "shard", "chunk").select("node", "ends").mapInArrow(
        _digests, "node long, ends string").collect()
    by_node, digest = {r["node"]: r for r in parts}, {r["node"]: r["ends"] for r in ends}
    parent = {number: above for (above, _), number in nodes.items()}
    children = {k: by_node[k]["n_children"] for k in by_node}
    for number in parent:
        children[parent[number]] += 1
    inner_words = {k: by_node[k]["words"] for k in by_node}
    inner_leaves = {k: int(not children[k]) for k in by_node}
    for number in sorted(parent, reverse=True):  # a parent's number is less than its children's
        inner_words[parent[number]] += inner_words[number]
        inner_leaves[parent[number]] += inner_leaves[number]
    empty = hashlib.sha256().hexdigest()
    return [(k, r["conv_id"], r["depth"], by_node[parent[k]]["conv_id"] if k else None, r["n_convs"], children[k],
             r["n_leaves"] + inner_leaves[k], r["saved_tokens"] - inner_words[k], digest.get(k, empty))
            for k, r in by_node.items()]


def prefix_trie(turns: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The nodes of the trie of (conv_id, turns); every conv_id once, turns as of `ordered_turns`.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves and saved_tokens (both over
    the subtree) and ends_sha256 (of the decimal conv_ids of the members that end at the node).
    """
    spark = prepare(turns.sparkSession)
    rows = stored(turns.select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"),
        F.transform("turns", lambda t: t["words"]).alias("words")), "paths")
    n = rows.count()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = min(MOST_SHARDS, max(1, min(partitions, math.ceil(n / 8)), math.ceil(n / shard_rows)))
    share = math.ceil(min(1.0, SAMPLED * shards / max(n, 1)) * (1 << 32))
    sample = rows.where(F.pmod(F.xxhash64("conv_id"), F.lit(1 << 32)) < share).select("path", "conv_id").collect()
    cuts = boundaries([(bytes(r["path"]), r["conv_id"]) for r in sample], shards)
    nodes = skeleton(cuts)
    found = stored(
        rows.mapInArrow(partial(_dealt, cuts=cuts), "conv_id long, path binary, words array<int>, shard int")
        .repartition(min(shards, 4 * partitions), "shard").sortWithinPartitions("shard", "path", "conv_id")
        .mapInArrow(partial(_finished, nodes=nodes), _OUT), "trie")
    schema = ("node long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
              "n_leaves long, saved_tokens long, ends string")
    top = spark.createDataFrame(_reduced(found, nodes, partitions), schema)
    above = F.broadcast(top.select("node", F.col("conv_id").alias("above")))  # bounded like the skeleton
    rest = found.where(F.col("kind") == _NODE).join(above, "node", "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return top.unionByName(rest.select(*top.columns)).drop("node").withColumnRenamed("ends", "ends_sha256")
