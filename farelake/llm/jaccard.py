"""Exact join of near-equal documents by word shingles, filtered under several global token orders.

A document is the set of its distinct shingles of five words. Two documents link when the Jaccard
similarity of their sets reaches `threshold`. The links are never listed for whole groups of copies: the
result is a class per document.

If two sets of sizes n and m link, then under *any* total order of tokens the first
n - ceil(threshold n) + 1 tokens of the one and the corresponding prefix of the other share a token. A pair
is a candidate only if it passes under every order used here:

1. Rarest first, over all sets. A token that lies in one set only can't be shared. With rare tokens first, a
   prefix is free of shared tokens exactly if the set has fewer than threshold n tokens that lie in other sets
   too, so this order reduces to a count per document. It discards documents that merely quote common passages.
2. Rarest first, over the sets that are left. Equal prefix tokens make buckets, which common passages don't join.
3. and 4. Two unrelated orders by fingerprint. Pairs from buckets must overlap in both of these prefixes as well, except
   the pairs with a bucket's leader: their exact distances are needed anyway, as bounds for all other pairs.

Verification counts the common tokens of whole sets.

Frequent tokens: for order 1 it only matters whether a second set holds a token. Sets of one batch that share a token
with at least CROWD sets know that there, so the token is sent once for the batch, marked, and its sets send numbers.

Large groups: within a bucket each document is first compared with one leader. Documents that link with it are
one component, whatever the other pairs are. Only pairs of different components with a common leader remain, and
of those the ones that the triangle inequality of the Jaccard distance, through the leader, doesn't rule out.
They are verified block by block, each set being sent once per block and not once per pair, so that no link between
components is lost and no task gets a whole large group.

Tokens and sets are 64-bit fingerprints. A false match needs two of the shingles compared to collide.

Edge cases: null text and text without words have an empty set and link with nothing. A text of fewer than five
words has one shingle, the whole sequence. Repeated rows are copies. Rows without doc_id take part; a group
of such rows alone has a null component_id. Other columns of the input are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm.common import LOWER, UPPER, collected, prepare, stored
from farelake.llm.components import components

SHINGLE = 5
#: Links need 100 * common >= THRESHOLD * union.
THRESHOLD = 75
#: Tokens of a bucket whose sets are counted in one task: 16 MB of tokens and as much for their owners.
BUCKET_TOKENS = 1 << 22
#: A token in at least so many sets of a batch is sent once for all of them.
CROWD = 4
#: Places in which the tokens of a batch are counted before they are compared.
PLACES = 1 << 20
#: Sets whose counts are added up in one task.
SLICE_SETS = 1 << 15
#: Bits of the map that keeps sets without partners out of the shuffle: 16 MB, whatever the input. With more
#: documents it lets more of them pass; the join behind it is exact.
MAP_BITS = 1 << 27
#: Tokens of a block of sets that are compared with each other in one task, and columns of a matrix there.
BLOCK_TOKENS = 1 << 18
COLUMNS = 1 << 13
#: Blocks of a large group are cut by distance from its leader into so many rings.
RINGS = 10
#: Words whose fingerprints a Python worker remembers.
REMEMBERED = 1 << 20

_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
_MIX = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD]


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes | None, words: dict) -> np.ndarray:
    """Sorted distinct fingerprints of the shingles of a text."""
    split = text.translate(_FOLD).split() if text else []
    h = np.fromiter(map(words.__getitem__, split), dtype=np.uint64, count=len(split))
    if len(h) < SHINGLE:
        return _scrambled((h * np.array(_MIX[: len(h)], dtype=np.uint64)).sum(keepdims=True) + np.uint64(len(h))) \
            if len(h) else h
    last = len(h) - SHINGLE + 1
    return np.unique(_scrambled(sum(h[i:last + i] * np.uint64(_MIX[i]) for i in range(SHINGLE))))


def set_key(tokens: np.ndarray) -> int:
    """Fingerprint of a whole set, as a signed number."""
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def prefix_length(n: int, threshold: int = THRESHOLD) -> int:
    return n - -(-threshold * n // 100) + 1


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = _Words()
    for batch in batches:
        sets = [shingle_set(text, words) for text in batch["text"].to_pylist()]
        yield pa.record_batch({
            "doc_id": batch["doc_id"],
            "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
            "node": pa.array([set_key(s) if len(s) else None for s in sets], pa.int64()),
        })


def _crowded(tokens: np.ndarray) -> np.ndarray:
    """Which of the tokens of a batch are in at least CROWD of its sets, a token coming once per set."""
    place = (tokens & np.uint64(PLACES - 1)).astype(np.int64)
    some = np.flatnonzero(np.bincount(place, minlength=PLACES)[place] >= CROWD)
    _, which, counts = np.unique(tokens[some], return_inverse=True, return_counts=True)
    out = np.zeros(len(tokens), dtype=bool)
    out[some[counts[which] >= CROWD]] = True
    return out


def _parts(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """(bucket, the bucket's part of each column), the buckets being sorted."""
    firsts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]][: len(bucket)])
    for i, j in zip(firsts, np.r_[firsts[1:], len(bucket)].astype(np.int64)):
        yield int(bucket[i]), *(c[i:j].tobytes() for c in columns)


_DEALT = "bucket int, nodes binary, sizes binary, tokens binary, marked binary, met binary, counts binary"


def _dealt(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows of `_DEALT`: a bucket of tokens, with one of

    * sets, how many tokens each has in the bucket, these tokens (one row per bucket and batch);
    * tokens marked as shared;
    * sets with the number of marked tokens each has; these go to the bucket of the set.

    Copies within a task are dealt once.
    """
    words, seen = _Words(), set()
    for batch in batches:
        sets, keys = [], []
        for text in batch["text"].to_pylist():
            tokens = shingle_set(text, words)
            if len(tokens) and (key := set_key(tokens)) not in seen:
                seen.add(key)
                sets.append(tokens)
                keys.append(key)
        if not sets:
            continue
        tokens, keys = np.concatenate(sets), np.array(keys, dtype=np.int64)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        crowded = _crowded(tokens)
        met = np.bincount(owner[crowded], minlength=len(sets)).astype(np.int32)
        marked = np.unique(tokens[crowded])
        tokens, owner = tokens[~crowded], owner[~crowded]

        def bucketed(tokens: np.ndarray) -> np.ndarray:
            return ((tokens >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)

        def low(tokens: np.ndarray) -> np.ndarray:
            return (tokens & np.uint64(0xFFFFFFFF)).astype(np.uint32)

        place = bucketed(tokens) * len(sets) + owner
        order = np.argsort(place, kind="stable")
        place = place[order]
        runs = np.flatnonzero(np.r_[True, place[1:] != place[:-1]][: len(place)])  # of one set in one bucket
        sizes = np.diff(np.r_[runs, len(place)]).astype(np.int32)
        out = []
        at = 0
        raw = low(tokens[order])
        for bucket, nodes, held in _parts(place[runs] // len(sets), keys[place[runs] % len(sets)], sizes):
            count = int(np.frombuffer(held, dtype=np.int32).sum())
            out.append((bucket, nodes, held, raw[at:at + count].tobytes(), None, None, None))
            at += count
        marked = marked[np.argsort(bucketed(marked), kind="stable")]
        out += [(bucket, None, None, None, part, None, None) for bucket, part in _parts(bucketed(marked), low(marked))]
        some = np.flatnonzero(met)
        some = some[np.argsort(keys[some] % buckets, kind="stable")]
        out += [(bucket, None, None, None, None, *part) for bucket, *part in _parts(keys[some] % buckets, keys[some], met[some])]
        names = ["bucket", "nodes", "sizes", "tokens", "marked", "met", "counts"]
        yield pa.record_batch([pa.array(c, pa.binary() if k else pa.int32()) for k, c in enumerate(zip(*out))], names=names)


def _shared(table: pa.Table, slices: int) -> pa.Table:
    """How many tokens of this bucket each set shares with other sets, packed by slices of the sets.

    A set with copies in several batches may bring a number from each. A token that none of them sent is marked in
    all, so the least of the numbers is enough.
    """
    nodes, sizes, token, marked, met, counted = (
        np.frombuffer(b"".join(table[c].drop_null().to_pylist()), dtype=kind)
        for c, kind in (("nodes", np.int64), ("sizes", np.int32), ("tokens", np.uint32),
                        ("marked", np.uint32), ("met", np.int64), ("counts", np.int32)))
    # One number a token and set, sorted in place: a group of BUCKET_TOKENS is a few times 32 MB.
    nodes, rank = np.unique(nodes, return_inverse=True)
    pair = token.astype(np.uint64)
    pair <<= np.uint64(32)
    pair |= np.repeat(rank.astype(np.uint32), sizes)
    pair.sort()
    pair = pair[np.r_[True, pair[1:] != pair[:-1]][: len(pair)]]
    token = (pair >> np.uint64(32)).astype(np.uint32)
    rank = pair.astype(np.uint32)  # the low half
    del pair
    shared = np.zeros(len(token), dtype=bool)
    same = token[1:] == token[:-1]
    shared[1:] |= same
    shared[:-1] |= same
    marked = np.unique(marked)
    begins, ends = (np.searchsorted(token, marked, side) for side in ("left", "right"))
    held = begins < ends
    steps = np.zeros(len(token) + 1, dtype=np.int8)
    steps[begins[held]] += 1
    steps[ends[held]] -= 1
    shared |= np.cumsum(steps, dtype=np.int8)[:-1].astype(bool)
    counts = np.bincount(rank[shared], minlength=len(nodes))
    nodes, counts = nodes[counts > 0], counts[counts > 0]
    order = np.lexsort((counted, met))
    met, counted = met[order], counted[order]
    least = np.r_[True, met[1:] != met[:-1]][: len(met)]
    nodes, counts = np.r_[nodes, met[least]], np.r_[counts, counted[least]]
    place = np.mod(nodes, slices)
    order = np.argsort(place, kind="stable")
    found, begins = np.unique(place[order], return_index=True)
    parts = np.split(order, begins[1:])
    return pa.table({
        "slice": pa.array(found, pa.int64()),
        "nodes": pa.array([nodes[p].tobytes() for p in parts[: len(found)]], pa.binary()),
        "counts": pa.array([counts[p].astype(np.int32).tobytes() for p in parts[: len(found)]], pa.binary())})


def _summed(table: pa.Table) -> pa.Table:
    """The counts of one slice over all buckets."""
    nodes = np.frombuffer(b"".join(table["nodes"].to_pylist()), dtype=np.int64)
    counts = np.frombuffer(b"".join(table["counts"].to_pylist()), dtype=np.int32)
    node, place = np.unique(nodes, return_inverse=True)
    return pa.table({"node": node, "shared": np.bincount(place, weights=counts, minlength=len(node)).astype(np.int64)})


def _kept_sets(batches: Iterator[pa.RecordBatch], bits) -> Iterator[pa.RecordBatch]:
    """The sets whose bit is set. Copies within a task come once."""
    words, seen = _Words(), set()
    for batch in batches:
        keys, sets = [], []
        for text in batch["text"].to_pylist():
            tokens = shingle_set(text, words)
            if not len(tokens) or (key := set_key(tokens)) in seen:
                continue
            place = key & (MAP_BITS - 1)
            if bits.value[place >> 3] >> (place & 7) & 1:
                seen.add(key)
                keys.append(key)
                sets.append(tokens.tobytes())
        if keys:
            yield pa.record_batch({"node": pa.array(keys, pa.int64()), "tokens": pa.array(sets, pa.binary())})


def _dealt_kept(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for node, raw in zip(batch["node"].to_pylist(), batch["tokens"].to_pylist()):
            tokens = np.frombuffer(raw, dtype=np.uint64)
            bucket = (tokens >> np.uint64(32)) % np.uint64(buckets)
            out += [(int(b), node, tokens[bucket == b].tobytes()) for b in np.unique(bucket)]
        if out:
            yield pa.record_batch(
                [pa.array(x, kind) for x, kind in zip(zip(*out), (pa.int32(), pa.int64(), pa.binary()))],
                names=["bucket", "node", "tokens"])


def _counted(table: pa.Table) -> pa.Table:
    """Beside the tokens of each set, in how many sets they are."""
    token = np.frombuffer(b"".join(table["tokens"].to_pylist()), dtype=np.uint64)
    _, place, counts = np.unique(token, return_inverse=True, return_counts=True)
    held = counts[place].astype(np.uint32)
    ends = np.cumsum(pc.binary_length(table["tokens"]).to_numpy() // 8)
    return pa.table({
        "node": table["node"], "tokens": table["tokens"],
        "held": pa.array([h.tobytes() for h in np.split(held, ends[:-1])], pa.binary())})


def _ordered(batches: Iterator[pa.RecordBatch], threshold: int) -> Iterator[pa.RecordBatch]:
    """Sets with their prefix under the order of rarest first."""
    for batch in batches:
        columns = {"tokens": [], "rare": []}
        for parts in batch["parts"].to_pylist():
            tokens = np.frombuffer(b"".join(p["tokens"] for p in parts), dtype=np.uint64)
            held = np.frombuffer(b"".join(p["held"] for p in parts), dtype=np.uint32)
            signed = tokens.view(np.int64)
            columns["tokens"].append(signed)
            columns["rare"].append(signed[np.lexsort((tokens, held))[: prefix_length(len(tokens), threshold)]])
        yield pa.record_batch(
            [batch["node"], batch["n"], *(pa.array(c, pa.list_(pa.int64())) for c in columns.values())],
            names=["node", "n", *columns])


def _bit_map(nodes: DataFrame) -> np.ndarray:
    """Bit map of the nodes' low bits, put together from at most MAP_BITS / 32768 parts."""
    place = (F.pmod("node", F.lit(MAP_BITS)) + 1).alias("place")
    parts = nodes.select(place).groupBy(F.bitmap_bucket_number("place").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    out = np.zeros(MAP_BITS // 8, dtype=np.uint8)
    for row in parts.toLocalIterator():
        begin = (row["part"] - 1) * 4096
        out[begin:begin + 4096] = np.frombuffer(row["bits"], dtype=np.uint8)
    return out


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with their sizes and the number of common tokens."""
    def side(name: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("tokens").alias(f"tokens_{name}"))

    return pairs.join(side("b"), "b").join(side("a"), "a").select(
        "a", "b", "n_a", "n_b", F.size(F.array_intersect("tokens_a", "tokens_b")).cast("long").alias("common"))


def _links(verified: DataFrame, threshold: int) -> DataFrame:
    return verified.where(F.lit(100) * F.col("common") >= threshold * (F.col("n_a") + F.col("n_b") - F.col("common")))


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Matrix of the numbers of common tokens, for sets with distinct tokens each."""
    sides = [np.concatenate(left), np.concatenate(right)]
    shared = np.intersect1d(*map(np.unique, sides), assume_unique=True)
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    rows = [np.repeat(np.arange(len(x)), [len(t) for t in x]) for x in (left, right)]
    for begin in range(0, len(shared), COLUMNS):
        some = shared[begin:begin + COLUMNS]
        flags = []
        for tokens, row, x in zip(sides, rows, (left, right)):
            place = np.minimum(np.searchsorted(some, tokens), len(some) - 1)
            met = some[place] == tokens
            flag = np.zeros((len(x), len(some)), dtype=np.float32)
            flag[row[met], place[met]] = 1
            flags.append(flag)
        out += (flags[0] @ flags[1].T).astype(np.int64)
    return out


def _prefixes(sets: list[np.ndarray], salt: int, threshold: int) -> list[np.ndarray]:
    return [
        s[np.argsort(_scrambled(s.view(np.uint64) ^ np.uint64(salt)), kind="stable")[: prefix_length(len(s), threshold)]]
        for s in sets]


def _block_links(table: pa.Table, threshold: int) -> pa.Table:
    """Links between documents of different components, of one block or across two."""
    second = table["second"].to_numpy(zero_copy_only=False)
    halves = [np.flatnonzero(~second), np.flatnonzero(second)]
    if not len(halves[1]):
        halves[1] = halves[0]
    sets = [np.array(x, dtype=np.int64) for x in table["tokens"].to_pylist()]
    node, component, far = (table[c].to_numpy() for c in ("node", "component", "far"))
    n = np.array([len(s) for s in sets])
    i, j = halves
    mask = component[i][:, None] != component[j]
    mask &= np.abs(far[i][:, None] - far[j]) <= 1 - threshold / 100 + 1e-9
    mask &= 100 * np.minimum(n[i][:, None], n[j]) >= threshold * np.maximum(n[i][:, None], n[j])
    if halves[0] is halves[1]:
        mask &= node[i][:, None] < node[j]
    for salt in _MIX[:2]:
        r, c = np.flatnonzero(mask.any(axis=1)), np.flatnonzero(mask.any(axis=0))
        if len(r):
            i, j, mask = i[r], j[c], mask[np.ix_(r, c)]
            mask &= common_counts(*(_prefixes([sets[k] for k in h], salt, threshold) for h in (i, j))) > 0
    r, c = np.flatnonzero(mask.any(axis=1)), np.flatnonzero(mask.any(axis=0))
    if not len(r):
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    i, j, mask = i[r], j[c], mask[np.ix_(r, c)]
    common = common_counts([sets[k] for k in i], [sets[k] for k in j])
    x, y = np.nonzero(mask & (100 * common >= threshold * (n[i][:, None] + n[j] - common)))
    return pa.table({"a": node[i[x]], "b": node[j[y]]})


def _links_apart(placed: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Links (a, b) between different components, among documents that share a leader.

    placed: (leader, node, n, component, leader_component, far). The documents of a leader are one block as
    long as their sets are small together. Otherwise they are cut into blocks by distance from the leader and by
    hash, each with about BLOCK_TOKENS tokens, and the pairs of blocks that can hold a link are tasks of
    their own.
    """
    apart = F.col("component") != F.col("leader_component")
    groups = placed.groupBy("leader").agg(F.sum("n").alias("total"), F.count_if(apart).alias("apart")).where("apart > 0")
    ring = F.floor(F.col("far") * RINGS)
    rows = placed.join(groups, "leader").withColumn("ring", F.when(F.col("total") <= BLOCK_TOKENS, -1).otherwise(
        ring + F.when(apart, 0).otherwise(2 * RINGS)).cast("int"))
    cuts = rows.groupBy("leader", "ring").agg(F.ceil(F.sum("n") / BLOCK_TOKENS).alias("cuts"))
    rows = rows.join(cuts, ["leader", "ring"]).withColumn("cut", F.pmod(F.xxhash64("node"), F.col("cuts"))).select(
        "leader", "ring", "cut", "node", "component", "far")
    blocks = cuts.select("leader", "ring", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)).alias("cut"))
    p, q = blocks.alias("p"), blocks.alias("q")
    near = F.abs(F.col("p.ring") % (2 * RINGS) - F.col("q.ring") % (2 * RINGS)) <= RINGS * (100 - threshold) // 100 + 1
    order = F.struct("p.ring", "p.cut") <= F.struct("q.ring", "q.cut")
    pairs = p.join(q, (F.col("p.leader") == F.col("q.leader")) & order & near & (F.col("p.ring") < 2 * RINGS)).select(
        F.col("p.leader").alias("leader"), *(F.col(f"{x}.{c}").alias(f"{c}_{x}") for x in "pq" for c in ("ring", "cut")))
    pair = [f"{c}_{x}" for x in "pq" for c in ("ring", "cut")]
    both = (F.col("ring_p") == F.col("ring_q")) & (F.col("cut_p") == F.col("cut_q"))
    sides = [
        rows.withColumnsRenamed({"ring": f"ring_{x}", "cut": f"cut_{x}"}).join(
            pairs.where(~both) if x == "q" else pairs, ["leader", f"ring_{x}", f"cut_{x}"])
        .select("leader", *pair, "node", "component", "far", F.lit(x == "q").alias("second")) for x in "pq"]
    return (
        sides[0].unionByName(sides[1]).join(sets.select("node", "tokens"), "node")
        .groupBy("leader", *pair).applyInArrow(lambda t: _block_links(t, threshold), "a long, b long").distinct()
    )


def _candidate_sets(docs: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """The sets that pass the rarest-first order: (node, n, tokens, rare)."""
    spark = docs.sparkSession
    texts = docs.select(F.col("text").cast("binary").alias("text"))
    total, held = classes.agg(F.coalesce(F.sum("n_shingles"), F.lit(0)), F.count(F.lit(1))).first()
    slices = max(1, math.ceil(held / SLICE_SETS))
    shared = (
        texts.mapInArrow(partial(_dealt, buckets=max(1, math.ceil(total / BUCKET_TOKENS))), _DEALT)
        .groupBy("bucket").applyInArrow(lambda t: _shared(t, slices), "slice long, nodes binary, counts binary")
        .groupBy("slice").applyInArrow(_summed, "node long, shared long")
    )
    passed = stored(
        classes.join(shared, "node").where(F.lit(100) * F.col("shared") >= threshold * F.col("n_shingles"))
        .select("node", F.col("n_shingles").alias("n")), "shared")
    bits = spark.sparkContext.broadcast(_bit_map(passed))
    kept = texts.mapInArrow(partial(_kept_sets, bits=bits), "node long, tokens binary").dropDuplicates(["node"])
    total = passed.agg(F.sum("n")).first()[0] or 0
    counted = (
        kept.join(passed, "node").select("node", "tokens")
        .mapInArrow(partial(_dealt_kept, buckets=max(1, math.ceil(4 * total / BUCKET_TOKENS))), "bucket int, node long, tokens binary")
        .groupBy("bucket").applyInArrow(_counted, "node long, tokens binary, held binary")
        .groupBy("node").agg(F.collect_list(F.struct("tokens", "held")).alias("parts"))
    )
    return stored(counted.join(passed, "node").select("node", "n", "parts").mapInArrow(
        partial(_ordered, threshold=threshold),
        "node long, n long, tokens array<long>, rare array<long>"), "sets")


def near_components(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, n_shingles, node, component_id) of every row of `docs` (doc_id long, text string).

    node: fingerprint of the document's set, null if that is empty. component_id: the least doc_id reachable
    by links.
    """
    prepare(docs.sparkSession)
    sized = stored(
        docs.select("doc_id", F.col("text").cast("binary").alias("text"))
        .mapInArrow(_sizes, "doc_id long, n_shingles long, node long"), "sized")
    classes = sized.where("node is not null").groupBy("node").agg(
        F.max("n_shingles").alias("n_shingles"), F.min("doc_id").alias("least_id"))
    sets = _candidate_sets(docs, classes, threshold)
    collected(docs.sparkSession)

    posted = sets.select(F.explode("rare").alias("token"), "node")
    # Buckets of the same sets are one bucket: copies share most of their tokens.
    buckets = (
        posted.groupBy("token").agg(
            F.count(F.lit(1)).alias("held"), F.bit_xor(F.xxhash64("node")).alias("x"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"), F.min("node").alias("leader"))
        .where("held > 1")
        .groupBy("held", "x", "y", "leader").agg(F.min("token").alias("token"))
        .select("token", "leader")
    )
    stars = posted.join(buckets, "token").where("node <> leader").select(
        F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    stars = stored(_verified(stars, sets), "stars")
    linked = _links(stars, threshold).select("a", "b")
    found = stored(components(linked, "a", "b"), "found")
    collected(docs.sparkSession)

    distance = F.lit(1.0) - F.col("common") / (F.col("n_a") + F.col("n_b") - F.col("common"))
    of_leader = found.select(F.col("node").alias("leader"), F.col("component").alias("leader_component"))
    placed = (
        stars.select(F.col("a").alias("leader"), F.col("b").alias("node"), F.col("n_b").alias("n"), distance.alias("far"))
        .join(found, "node", "left").join(of_leader, "leader", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .withColumn("leader_component", F.coalesce("leader_component", "leader"))
    )
    placed = stored(placed, "placed")
    if not placed.where("component <> leader_component").isEmpty():
        more = stored(_links_apart(placed, sets, threshold), "more")
        if not more.isEmpty():
            found = components(linked.unionByName(more), "a", "b")

    named = classes.join(found, "node", "left").select(
        "node", "least_id", F.coalesce("component", "node").alias("group"))
    least = named.groupBy("group").agg(F.min("least_id").alias("component_id"))
    ids = named.join(least, "group").select("node", "group", "component_id")
    return sized.join(ids, "node", "left").select(
        "doc_id", "n_shingles", "node", "group",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _with_node(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    words = _Words()
    for batch in batches:
        sets = [shingle_set(text, words) for text in batch[f"{name}text"].to_pylist()]
        nodes = pa.array([set_key(s) if len(s) else None for s in sets], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch[c] for c in batch.schema.names if c != f"{name}text"] + [nodes],
            names=[c for c in batch.schema.names if c != f"{name}text"] + [f"{name}node"])


def one_of_each(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of `docs` without near copies: of each group the one with the least doc_id, with all its columns.

    Rows that are copies even in their doc_id are one row. Documents with an empty set all stay. A group without
    any doc_id keeps one row.
    """
    placed = stored(near_components(docs, threshold), "placed")
    stays = placed.where("node is not null").groupBy("group").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "node")).alias("s"))
    own = "_" * (1 + max((len(c) for c in docs.columns), default=0))  # longer than any column's name
    stays = stays.select(F.col("s.doc_id").alias(f"{own}id"), F.col("s.node").alias(f"{own}key"))
    noded = docs.withColumn(f"{own}text", F.col("text").cast("binary"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", {own}node long"
    noded = noded.mapInArrow(partial(_with_node, name=own), schema).where(f"{own}node is not null")
    full = noded.join(
        stays, (noded[f"{own}node"] == stays[f"{own}key"]) & noded["doc_id"].eqNullSafe(stays[f"{own}id"]), "left_semi")
    return full.dropDuplicates([f"{own}node", "doc_id"]).select(*docs.columns).unionByName(
        docs.where(~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")))
