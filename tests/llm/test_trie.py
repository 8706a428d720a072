"""The conversation trie against a plain one, over many shard sizes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from farelake.llm import trie
from farelake.llm.common import stored

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def plain_trie(paths):
    """paths: conv_id -> tuple of (role, text)."""
    members = defaultdict(list)
    for conv_id, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(conv_id)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    rows = []
    for node, own in members.items():
        beneath = [x for x in members if x[:len(node)] == node]
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode().split()) for x in beneath if x)
        ends = ",".join(map(str, sorted(c for c in own if paths[c] == node)))
        rows.append((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(children[node]),
                     sum(not children[x] for x in beneath), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def result(turns, **settings):
    return sorted((tuple(r) for r in trie.prefix_trie(turns, **settings).select(*COLUMNS).collect()), key=str)


def conversations(seed, n, hot):
    rng = random.Random(seed)
    paths = {}
    for i in range(n):
        conv_id = rng.randrange(-500, 5000)
        length = rng.choice([0, 1, 1, 2, 3, 4, 6])
        paths[conv_id] = tuple((rng.choice(["user", "assistant"]), rng.choice(["", "a", "b c", "d  e\tf"])) for _ in range(length))
        if rng.random() < hot:
            paths[conv_id] = (("user", "hello there"), ("assistant", "x")) + paths[conv_id][:rng.choice([0, 0, 0, 1])]
    return paths


def frame(spark, paths):
    rows = [(c, i, *turn, 1) for c, path in paths.items() for i, turn in enumerate(path)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA + ", path int")


@pytest.mark.parametrize("shard_rows", [2, 7, 100_000])
@pytest.mark.parametrize("hot", [0.0, 0.5])
def test_plain(spark, shard_rows, hot, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_IDS", 3)
    paths = {c: p for c, p in conversations(shard_rows, 150, hot).items() if p}
    turns = stored(trie.ordered_turns(frame(spark, paths)), "turns")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        assert result(turns, shard_rows=shard_rows) == plain_trie(paths)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_shards_and_skeleton():
    """Without Spark: every cut of the rows gives the skeleton's property and the same nodes."""
    digest = lambda x: bytes([x]) * trie.DIGEST
    rng = random.Random(4)
    rows = sorted((b"".join(digest(rng.randrange(3)) for _ in range(rng.randrange(5))), i) for i in range(300))
    for shards in (1, 2, 5, 40):
        cuts = trie.boundaries(rng.sample(rows, 100), shards)
        assert cuts == sorted(set(cuts))
        nodes = trie.skeleton(cuts)
        split = defaultdict(set)
        for path, conv_id in rows:
            shard = trie.bisect_right(cuts, (path, conv_id))
            for d in range(len(path) // trie.DIGEST + 1):
                split[path[:d * trie.DIGEST]].add(shard)
        known, paths = {0: b""}, {b""}
        for (above, turn), number in nodes.items():
            known[number] = known[above] + turn
            paths.add(known[number])
        assert all(path in paths for path, found in split.items() if len(found) > 1)


def rebuilt(paths, family=20, most=4):
    out = {}
    for c, path in paths.items():
        h = zlib.crc32(str(c).encode()) % most
        head = int(c - (c % family if c >= 0 else -(-c % family)))
        out[c] = paths.get(head, ())[:h] + path[h:]
    return out


def test_shared_openings(spark):
    paths = {c: p for c, p in conversations(9, 300, 0.2).items() if p}
    turns = trie.with_shared_openings(trie.ordered_turns(frame(spark, paths)), 20, 4)
    want = rebuilt(paths)
    assert any(not p for p in want.values())
    assert result(turns) == plain_trie(want)


def test_long_conversation(spark):
    paths = {1: tuple(("user", str(i)) for i in range(3000)), 2: tuple(("user", str(i)) for i in range(2999)), 3: (("user", "0"),)}
    got = result(trie.ordered_turns(frame(spark, paths)), shard_rows=1)
    assert len(got) == 3001
    assert [r for r in got if r[1] == 0] == [(1, 0, None, 3, 1, 1, 2 + 2998, hashlib.sha256().hexdigest())]


def test_edges(spark):
    rows = [(1, None, "user", "first"), (1, 0, None, None), (1, 2, "user", "x y"), (1, 2, "user", "x y"),
            (None, 0, "user", "nobody"), (2, 5, "user", "first"), (2, 7, "", "")]
    paths = {1: (("user", "first"), ("", ""), ("user", "x y"), ("user", "x y")), 2: (("user", "first"), ("", ""))}
    turns = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA + ", words string")
    assert result(trie.ordered_turns(turns)) == plain_trie(paths)
    assert trie.prefix_trie(trie.ordered_turns(spark.createDataFrame([], SCHEMA))).count() == 0
    # a role's end and a text's beginning aren't mixed up
    two = spark.createDataFrame([(1, 0, "ab", "c"), (2, 0, "a", "bc")], SCHEMA)
    assert trie.prefix_trie(trie.ordered_turns(two)).count() == 3
