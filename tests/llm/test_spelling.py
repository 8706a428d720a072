"""Spelling variants against brute force."""

import random
import zlib
from collections import Counter

import pytest

from farelake.llm import spelling


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(counts):
    rows, form = [], {}
    close = {w: [x for x in counts if near(w, x)] for w in counts}
    for w, found in close.items():
        best = min(found, key=lambda x: (-counts[x], x.encode()), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, counts[w], len(close[w]), counts[form[w]] if form[w] else None))
    return sorted(rows, key=str)


def words(seed, n, letters="abcé", least=5, most=11):
    rng = random.Random(seed)
    found = {}
    while len(found) < n:
        word = "".join(rng.choice(letters) for _ in range(rng.randint(least, most)))
        found[word] = rng.choice([3, 4, 9, 30, 100])
    return found


@pytest.mark.parametrize("lengths,most_words", [((8, 5, 4, 3), 512), ((8, 5, 4, 3), 20), ((6, 3), 5), ((3,), 1), ((4, 3), 0)])
def test_brute_force(spark, lengths, most_words):
    counts = words(most_words, 600)
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = sorted((tuple(r) for r in spelling.variants(frame, lengths, most_words).collect()), key=str)
    assert got == plain_variants(counts)


@pytest.mark.parametrize("longest,most_words", [(8, 10), (4, 3), (3, 0)])
def test_bounds_hold(longest, most_words):
    """Near words have at least as many lists in common as either bound, and meet in one that is looked up."""
    counts = words(longest, 400, "abc", most=7)
    frequent = set()
    for size in range(spelling.SHORTEST, longest):
        held = Counter()
        for word in counts:
            marked = spelling.OPEN + word + spelling.CLOSE
            for side, s in enumerate((marked, marked[::-1])):
                held.update({(side, i, s[i:i + size]) for i in range(len(s) - size + 1)})
        frequent |= {gram for gram, n in held.items() if n > most_words}
    listed = {word: spelling.lists(word, frequent, longest) for word in counts}

    def agreed(word):
        marked = spelling.OPEN + word + spelling.CLOSE
        return {(side, s[:end]) for side, s in enumerate((marked, marked[::-1]))
                for _, end in spelling.variable_grams(s, side, frequent, longest)}

    pairs = [(a, b) for a in counts for b in counts if a < b and near(a, b)]
    assert len(pairs) > 50
    for a, b in pairs:
        most = max(listed[a][1], listed[b][1])
        assert len(agreed(a) & agreed(b)) >= most
        assert most == 0 or set(listed[a][0]) & set(listed[b][0])
    if longest == 3:
        assert all(least > 0 for _, least in listed.values())


def test_documents(spark):
    rng = random.Random(8)
    vocabulary = list(words(2, 60, "abcdefg")) + ["ab", "x"]
    texts = [" ".join(rng.choice([w, w.upper(), w.title()]) + rng.choice(["", ",", "1", "_"]) for w in rng.choices(vocabulary, k=80)) for _ in range(120)]
    rows = list(enumerate(texts)) + [(500, None), (501, ""), (502, "12 !"), (None, "Hello hello hello HELLO"), (7, texts[7]), (503, "ÀÉàé " * 4 + "z" * 100_000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int")
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    counts = Counter()
    slips = 0
    for i, text in rows:
        for run in spelling_runs(text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run, slips = run[:h % len(run)] + run[h % len(run) + 1:], slips + 1
            counts[run] += 1
    assert slips > 20
    want = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    assert dict(map(tuple, spelling.counted_words(docs).collect())) == want


def spelling_runs(text):
    run = ""
    for c in text + " ":
        if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
            run += c
        elif run:
            yield run
            run = ""


def test_chain_of_forms(spark):
    counts = {"abcde" + "f" * k: 3 * 2 ** k for k in range(12)}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = sorted((tuple(r) for r in spelling.variants(frame).collect()), key=str)
    assert got == plain_variants(counts)
    assert {r[2] for r in got} == {"abcde" + "f" * 11}


def test_words_about_the_long_ones(spark, monkeypatch):
    """Every pair across the length from which the middle is looked up."""
    monkeypatch.setattr(spelling, "LONG", 20)
    rng = random.Random(6)
    counts = {}
    for _ in range(60):
        word = "".join(rng.choice("ab") for _ in range(rng.randint(17, 22)))
        for _ in range(5):
            counts[word] = rng.choice([3, 6, 50])
            i, c = rng.randrange(len(word) + 1), rng.choice("abé")
            word = rng.choice([word[:i] + c + word[i:], word[:i] + word[i + 1:], word[:i] + c + word[i + 1:]])
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = sorted((tuple(r) for r in spelling.variants(frame, most_words=10).collect()), key=str)
    assert got == plain_variants(counts)


def test_long_words_and_ties(spark):
    long = "ab" * 20_000
    counts = {long: 3, long + "a": 6, long[:-1]: 6, "aaaaa": 5, "aaaab": 10, "aaaac": 10}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r["word"]: (r["form"], r["n_near"]) for r in spelling.variants(frame).collect()}
    assert got[long] == (min(long + "a", long[:-1]), 2)
    assert got["aaaaa"] == ("aaaab", 2)


def test_empty(spark):
    assert spelling.variants(spark.createDataFrame([], "word string, n long")).count() == 0
    assert spelling.counted_words(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        spelling.near_pairs(spark.createDataFrame([], "word string, n long"), lengths=(8, 4))
