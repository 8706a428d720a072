"""Components of near-equal documents against all pairs."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from farelake.llm import jaccard


def plain(rows, threshold=75):
    def shingles(text):
        w = (text or "").encode().translate(jaccard._FOLD).split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= threshold * (len(sets[i]) + len(sets[j]) - common):
                group[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [(doc, len(sets[i]), least.get(find(i))) for i, (doc, _) in enumerate(rows)]


def documents(seed, families=12, copies=25):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") * rng.randrange(1, 4) + str(rng.randrange(90))
    passage = [word() for _ in range(40)]
    texts = []
    for _ in range(families):
        base = [word() for _ in range(rng.randrange(8, 90))] + passage * rng.randrange(2)
        for _ in range(rng.randrange(1, copies)):
            text = list(base)
            for _ in range(rng.randrange(0, 8)):
                text[rng.randrange(len(text))] = word()
            texts.append(" ".join(text))
            base = text if rng.random() < 0.3 else base  # chains of copies of copies
    texts += [" ".join(passage), " ".join(passage).upper(), "one two three", "ONE  two\tthree", "one two", "", "  \n ", None]
    rng.shuffle(texts)
    return [(i * 3, t) for i, t in enumerate(texts)]


def test_like_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 300)  # large groups are cut into blocks
    for seed in (1, 2):
        rows = documents(seed)
        rows += [rows[0], rows[5], (None, rows[7][1]), (None, "only without an id here ok"), (None, None)]
        docs = spark.createDataFrame([(d, t, d, "x") for d, t in rows], "doc_id long, text string, node long, component_id string")
        got = jaccard.near_components(docs).select("doc_id", "n_shingles", "component_id").collect()
        assert sorted(map(tuple, got), key=str) == sorted(plain(rows), key=str)


def test_one_large_group(spark, monkeypatch):
    """Near copies whose distances straddle the threshold, in one bucket."""
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 500)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        text = list(base)
        for _ in range(rng.choice([1, 2, 3, 4])):
            text[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.near_components(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(plain(rows))


def test_one_of_each(spark):
    rows = documents(3)
    rows += [rows[0], rows[4], (None, "nobody knows my own number here")]
    docs = spark.createDataFrame([(d, t, 7) for d, t in rows], "doc_id long, text string, stays int")
    got = jaccard.one_of_each(docs)
    assert got.columns == docs.columns
    want = plain(rows)
    empty = [d for d, n, _ in want if not n]
    named = {c for _, n, c in want if n and c is not None}
    assert sorted((r["doc_id"] for r in got.collect()), key=str) == sorted([*empty, *named, None], key=str)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.near_components(empty).count() == 0
    assert jaccard.one_of_each(empty).count() == 0


def test_common_counts(monkeypatch):
    monkeypatch.setattr(jaccard, "COLUMNS", 7)
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(-50, 50, rng.integers(1, 60))) for _ in range(20)]
    got = jaccard.common_counts(sets[:8], sets[8:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[8:]] for a in sets[:8]]


def test_counts_of_shared_tokens():
    """Through batches and buckets, each set's number of tokens in other sets: exact without copies, never too small with them."""
    rng = np.random.default_rng(3)
    passage = " ".join(f"p{i}" for i in range(30))
    own = [" ".join(f"w{rng.integers(60)}" for _ in range(rng.integers(1, 25))) for _ in range(120)]
    texts = [(t + " " + passage if i % 3 == 0 else t).encode() for i, t in enumerate(own)] + [b"", None, b"a", b"a b c d e"]
    sets = {jaccard.set_key(s): s for t in texts if len(s := jaccard.shingle_set(t, jaccard._Words()))}
    holders = Counter(token for s in sets.values() for token in s.tolist())
    want = {key: sum(holders[t] > 1 for t in s.tolist()) for key, s in sets.items()}
    for copies in (1, 3):
        dealt = []
        for k in range(4):  # four tasks of several batches; with copies, texts are in all of them
            rows = texts[k::4] if copies == 1 else [texts[i] for i in rng.permutation(len(texts))]
            batches = [pa.record_batch({"text": pa.array(rows[i:i + 17], pa.binary())}) for i in range(0, len(rows), 17)]
            dealt += jaccard._dealt(iter(batches), 5)
        assert any(b["marked"].null_count < len(b) for b in dealt)
        whole = pa.Table.from_batches(dealt)
        parts = pa.concat_tables([jaccard._shared(whole.filter(pc.equal(whole["bucket"], b)), 3) for b in range(5)])
        got = {}
        for b in range(3):
            summed = jaccard._summed(parts.filter(pc.equal(parts["slice"], b)))
            got |= dict(zip(summed["node"].to_pylist(), summed["shared"].to_pylist()))
        if copies == 1:
            assert got == {key: n for key, n in want.items() if n}
        assert all(got.get(key, 0) >= n for key, n in want.items())


def test_counting_shared_tokens_is_lean():
    """A bucket's tokens are counted right, marked ones and copies of a set included, in under 40 bytes a token."""
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 1 << 20, 500, dtype=np.uint32)) for _ in range(600)]
    nodes = [*range(0, 5900, 10), *range(0, 100, 10)]  # the last ten are copies of the first
    sets[590:] = sets[:10]
    marked = np.arange(0, 1 << 20, 1000, dtype=np.uint32)
    row = {"nodes": np.array(nodes, np.int64).tobytes(), "sizes": np.array([len(s) for s in sets], np.int32).tobytes(),
           "tokens": np.concatenate(sets).tobytes(), "marked": marked.tobytes(), "met": None, "counts": None}
    table = pa.table({c: pa.array([v], pa.binary()) for c, v in row.items()})
    tracemalloc.start()
    found = jaccard._shared(table, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * sum(map(len, sets))
    got = {}
    for part in found.to_pylist():
        got |= dict(zip(np.frombuffer(part["nodes"], np.int64).tolist(), np.frombuffer(part["counts"], np.int32).tolist()))
    held = Counter(t for s in sets[:590] for t in s.tolist())
    common = set(marked.tolist())
    want = {n: sum(held[t] > 1 or t in common for t in s.tolist()) for n, s in zip(nodes[:590], sets)}
    assert got == {n: k for n, k in want.items() if k}


def test_no_blocks_without_documents_apart(spark, monkeypatch):
    """Groups that are one component with their leader need no job for pairs within them."""
    monkeypatch.setattr(jaccard, "_links_apart", lambda *_: pytest.fail("looked for links apart"))
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text), (2, text + " end"), (3, "something else altogether here now")], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.near_components(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3}
