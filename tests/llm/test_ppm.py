"""The language-model scores against a plain version."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from farelake.llm import ppm


def plain_model(texts, order):
    counts = defaultdict(Counter)
    for text in texts:
        symbols = [ppm.END] * order + list(text) + [ppm.END]
        for i in range(order, len(symbols)):
            for k in range(order + 1):
                counts[tuple(symbols[i - k:i])][symbols[i]] += 1
    return counts


def plain_probability(counts, context, symbol, held):
    """Method C with exclusion, from the longest held context down."""
    while context and context not in held:
        context = context[1:]
    excluded, chance = set(), 1.0
    while True:
        seen = {s: n for s, n in counts.get(context, {}).items() if s not in excluded}
        if seen:
            full = len(excluded) + len(seen) == ppm.SYMBOLS
            total = sum(seen.values()) + (0 if full else len(seen))
            if symbol in seen:
                return chance * seen[symbol] / total
            chance *= len(seen) / total
        excluded |= seen.keys()
        if not context:
            return chance / (ppm.SYMBOLS - len(excluded))
        context = context[1:]


def plain_cell(n):
    step = 2 ** max(0, math.floor(math.log2(n / 64)))
    return math.ceil(n / step) * step


def plain_score(counts, text, order, held):
    symbols = [ppm.END] * order + list(text) + [ppm.END]
    return sum(math.log10(plain_probability(counts, tuple(symbols[i - order:i]), symbols[i], held))
               for i in range(order, len(symbols)))


def entries(counts, held):
    rows = []
    for context in held | {()}:
        packed = 0
        for s in context:
            packed = packed << 9 | s
        rows += [(len(context), packed, s, n) for s, n in counts.get(context, {}).items()]
    return [np.array(x, dtype=np.int64) for x in zip(*sorted(rows))]


@pytest.mark.parametrize("most,everything", [(10**9, 256), (30, 256), (10**9, 100), (3, 0)])
def test_automaton_is_the_plain_model(most, everything):
    rng = random.Random(most)
    texts = [bytes(rng.choice(b"abcd ") for _ in range(rng.randrange(60))) for _ in range(30)] + [b"", bytes(range(everything))]
    order = 3
    counts = plain_model(texts, order)
    sizes = sorted(((sum(c.values()), k) for k, c in counts.items() if k), reverse=True)
    least = sizes[most][0] if most < len(sizes) else 0
    held = {k for n, k in sizes if n > least}
    model = ppm.automaton(*entries(counts, held))
    assert np.allclose((10.0 ** model[2][:, model[0][:ppm.SYMBOLS]].astype(float)).sum(1), 1, atol=1e-5)
    new = [*texts, b"abcabcabc", b"xyz" * 50, b"a" * 700]
    got = ppm.automaton_scores(new, *model, order, chunk=16)
    assert np.allclose(got, [plain_score(counts, t, order, held) for t in new], rtol=1e-5)
    assert np.allclose(got, ppm.automaton_scores(new, *model, order, chunk=512))


def test_documents(spark):
    rng = random.Random(5)
    vocabulary = ["the", "Cat", "sat", "on", "mat", "été", "x\vy"]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(30))), "extra") for i in range(40)]
    rows += [(41, None, "extra"), (42, "", "extra"), (43, "never seen words", "extra"), (None, "the cat", "extra"), (3, rows[3][1], "extra")]
    rows += [(44, "mat " * 5000, "extra")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = sorted(map(tuple, ppm.scored(docs, order=3, most=50, frequent=3).collect()), key=str)
    fold = lambda t: (t or "").encode().translate(ppm._FOLD)
    out = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _, _ in rows]
    train = [fold(t) for (_, t, _), o in zip(rows, out) if not o]
    words = Counter(w for t in train for w in [*t.split(), None])
    total, different = sum(words.values()), len(words)
    counts = plain_model(train, 3)
    held = set()
    cells = Counter(plain_cell(sum(c.values())) for k, c in counts.items() if k)
    for cell in sorted(cells, reverse=True):
        if sum(n for c, n in cells.items() if c >= cell) <= 50:
            held = {k for k, c in counts.items() if k and plain_cell(sum(c.values())) >= cell}
    want = []
    for (i, t, _), o in zip(rows, out):
        tokens = [*fold(t).split(), None]
        base = sum(math.log10((words[w] + 0.5) / (total + 0.5 * (different + 1))) for w in tokens)
        want.append((i, o, len(tokens), sum(w in words for w in tokens), total, base, plain_score(counts, fold(t), 3, held)))
    want.sort(key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-5)


def test_every_context_is_used(spark):
    """Half of the contexts occur once and are more than any fixed number of frequent ones would leave room for."""
    rng = random.Random(11)
    rows = [(i, "".join(rng.choice("abcdefghij ") for _ in range(600))) for i in range(100)]
    train = [t.encode() for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    counts = plain_model(train, 5)
    held = {k for k in counts if k}
    assert len(held) > 1 << 15
    got = {r["doc_id"]: r["score"] for r in ppm.scored(spark.createDataFrame(rows, "doc_id long, text string"), frequent=500).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        assert got[i] == pytest.approx(plain_score(counts, t.encode(), 5, held), rel=1e-9)


def test_empty_table(spark):
    assert ppm.scored(spark.createDataFrame([], "doc_id long, text string")).count() == 0
