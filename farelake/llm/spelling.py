"""Groups of spelling variants: words that differ by one inserted, deleted or replaced character.

Near words are found with an index of grams of variable length:

1. Dictionary. A gram, at a distance from an end of the word, is frequent if more than `LONGEST` words hold it there.
   Only what extends a frequent gram is counted, so the dictionary is pruned while it is built. It is read from both
   ends: grams of the words and of the reversed words.
2. Decomposition. From every place the shortest gram is taken that isn't frequent (or has `longest` characters), unless it lies
   inside one taken before. Words carry a mark at both ends.
3. Affected grams. Let the edit be at one place. Grams of the forward decomposition that end before it are the same in
   both words, and so are those of the backward decomposition that begin after it: a gram ends where it does because of its
   own characters, and one that reaches the edit does so in both words. The least number of grams that no edit can
   touch is the word's bound: a near word has at least so many grams in common with it.
4. Lists. Grams are ordered by their distance from the end they are counted from, farthest first. Of a word with g grams
   and the bound b only the first g - b + 1 are looked up: near words meet in one of their lists. Because
   everything before an untouched gram is the same too, a list holds the words that agree up to the gram's end.
5. Verification by edit distance, and every pair once.

Words whose bound is 0 find all words whose bound isn't. Those among themselves go to a further round with a
dictionary of their own and shorter grams (`LENGTHS`). With grams of at most three characters no word of `LEAST_CHARS` characters
has bound 0: of its seven characters with the marks, an edit leaves three on one side. So no pair is lost.

Words of `LONG` characters and more look up four lists only: from each side the last gram that ends in the first half, and the
last that ends a character earlier. An edit leaves one half as it is, and halves of near words differ by at most
one character. So a word has at most as many entries as `LONG`, however long it is.

Bounds: a dictionary has at most `MOST_GRAMS` entries per length; with more words, frequent means more than `LONGEST`.
All counts are combined before they are shuffled.

Edge cases: null texts have no words. Rows without doc_id count as those whose doc_id is the empty text. Repeated rows
count each. An empty table has no words. Other columns of the input are not looked at. Ties go to the word that is
smaller by code points.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import partial, reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm.common import LOWER, UPPER, prepare, stored

RUN = "[A-Za-zÀ-ÿ]+"
#: A run is written with one character less if this divides the checksum of its place.
SLIPS = 97
LEAST_CHARS, LEAST_COUNT = 5, 3
SHORTEST = 2
#: Longest grams of the rounds.
LENGTHS = (8, 5, 4, 3)
LONGEST = 512
#: Characters from which a word looks up the lists at its middle. Words of just this length look up both kinds.
LONG = 64
MOST_GRAMS = 1 << 17
#: Ends of a word; they can't be edited.
OPEN, CLOSE = "\x02", "\x03"

#: What a side of a word is counted from; the place of a gram there.
Frequent = set[tuple[int, int, str]]


def counted_words(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of `docs` (doc_id, text), slips of the pen included."""
    run = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run"))
    check = F.crc32(F.concat("id", F.lit(":"), "run"))
    at = (check % F.length("run")).cast("int")
    slip = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(check % SLIPS == 0, slip).otherwise(F.col("run"))
    return run.select(word.alias("word")).where(F.length("word") >= least_chars).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def frequent_grams(words: DataFrame, longest: int, most_words: int = LONGEST) -> Frequent:
    """(side, place, gram) of the grams, shorter than `longest`, in more words than a list should hold."""
    spark = words.sparkSession
    words = words.where(F.length("word") <= LONG)
    chars = words.agg(F.sum(F.length("word") + 2)).first()[0] or 0
    least = max(most_words, 2 * chars // MOST_GRAMS)
    marked = F.concat(F.lit(OPEN), "word", F.lit(CLOSE))
    sides = words.select(F.posexplode(F.array(marked, F.reverse(marked))).alias("side", "s"))
    held: Frequent = set()
    shorter = None
    for size in range(SHORTEST, longest):
        grams = sides.where(F.length("s") >= size).select(
            "side", "s", F.explode(F.sequence(F.lit(0), F.length("s") - size)).alias("place")).select(
            "side", "place", F.substring("s", F.col("place") + 1, F.lit(size)).alias("gram"))
        if shorter is not None:
            grams = grams.withColumn("start", F.left("gram", F.lit(size - 1))).join(
                F.broadcast(shorter), ["side", "place", "start"], "left_semi")
        rows = grams.groupBy("side", "place", "gram").agg(F.count(F.lit(1)).alias("n")).where(
            F.col("n") > least).select("side", "place", "gram").collect()
        if not rows:
            break
        held |= {tuple(r) for r in rows}
        shorter = spark.createDataFrame(rows, "side int, place int, start string")
    return held


def variable_grams(s: str, side: int, frequent: Frequent, longest: int) -> list[tuple[int, int]]:
    """(place, end) of the grams of a marked word; no gram lies inside another."""
    found, last, n = [], 0, len(s)
    for place in range(n - SHORTEST + 1):
        end = place + SHORTEST
        while end < n and end - place < longest and (side, place, s[place:end]) in frequent:
            end += 1
        if end > last:
            found.append((place, end))
            last = end
    return found


def bound(forward: list[int], backward: list[int], n: int) -> int:
    """Least number of grams, given their ends from either side, that one edit leaves as they are."""
    return min(bisect_left(forward, i + 1) + bisect_left(backward, n - i) for i in range(1, n - 1))


def lists(word: str, frequent: Frequent, longest: int) -> tuple[list[int], int]:
    """The word's lists to look up, and its bound."""
    keys, ends, middle = [], [], []
    marked = OPEN + word + CLOSE
    halves = (len(marked) // 2 - 1, len(marked) // 2)
    for side, s in enumerate((marked, marked[::-1])):
        own = [end for _, end in variable_grams(s, side, frequent, longest)]
        state, done = xxhash.xxh3_64(str(side)), 0
        for end in own:
            state.update(s[done:end])
            done = end
            keys.append((-end, side, state.intdigest() - (1 << 63)))
        if len(word) >= LONG:
            middle += [keys[len(keys) - len(own) + bisect_right(own, half) - 1] for half in halves]
        ends.append(own)
    least, kept = 1, set(middle)
    if len(word) <= LONG:
        least = bound(*ends, len(marked))
        kept |= set(sorted(keys)[:len(keys) - max(least, 1) + 1])
    return sorted({key for *_, key in kept}), least


def _listed(batches: Iterator[pa.RecordBatch], frequent: Frequent, longest: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [lists(word, frequent, longest) for word in batch["word"].to_pylist()]
        yield pa.record_batch({
            "word": batch["word"], "n": batch["n"],
            "lists": pa.array([keys for keys, _ in found], pa.list_(pa.int64())),
            "bound": pa.array([least for _, least in found], pa.int32()),
        })


def _met(listed: DataFrame) -> DataFrame:
    """Near pairs (a, a_n, b, b_n), perhaps repeated, of which one word at least has a bound above zero."""
    entries = listed.select("word", "n", "bound", F.explode("lists").alias("list"))
    a = entries.where("bound > 0").select(F.col("word").alias("a"), F.col("n").alias("a_n"), "list")
    b = entries.select(F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("bound").alias("b_bound"), "list")
    once = (F.col("a") < F.col("b")) | (F.col("b_bound") == 0)
    near = (F.abs(F.length("a") - F.length("b")) <= 1) & (F.levenshtein("a", "b", 1) == 1)
    return a.join(b, (a["list"] == b["list"]) & once & near).select("a", "a_n", "b", "b_n")


def near_pairs(words: DataFrame, lengths: tuple[int, ...] = LENGTHS, most_words: int = LONGEST) -> DataFrame:
    """(a, a_n, b, b_n) of all words (word, n) at edit distance 1, every pair once. Words have at least `LEAST_CHARS` characters."""
    if lengths[-1] > 3:
        raise ValueError("the last round needs grams of at most three characters to be complete")
    rest, found = words, []
    for longest in lengths:
        frequent = frequent_grams(rest, longest, most_words)
        listed = stored(rest.mapInArrow(
            partial(_listed, frequent=frequent, longest=longest),
            "word string, n long, lists array<long>, bound int"), "lists")
        found.append(stored(_met(listed).distinct(), "near"))
        rest = listed.where("bound = 0").select("word", "n")
        if rest.isEmpty():
            break
    return reduce(DataFrame.unionByName, found)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form); root follows the forms to the last. Steps double, so there are few rounds."""
    now = stored(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = stored(now.join(ahead, "root").select("word", F.col("next").alias("root"), (
            F.col("next") != F.col("root")).alias("moved")), "roots")
        now = further.select("word", "root")
        if further.where("moved").isEmpty():
            return now


def variants(words: DataFrame, lengths: tuple[int, ...] = LENGTHS, most_words: int = LONGEST) -> DataFrame:
    """word, form, root, n, n_near and form_n of every row of `words` (word, n)."""
    prepare(words.sparkSession)
    words = stored(words, "words")
    pairs = near_pairs(words, lengths, most_words)
    both = pairs.unionByName(pairs.select(
        F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n")))
    best = both.groupBy("a").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("n"), F.col("b").alias("word"))).alias("best"))
    enough = -F.col("best.n") >= 2 * F.col("n")
    formed = stored(words.join(best, words["word"] == best["a"], "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.word")).alias("form"), F.when(enough, -F.col("best.n")).alias("form_n")), "forms")
    return formed.join(roots(formed), "word").select("word", "form", "root", "n", "n_near", "form_n")
