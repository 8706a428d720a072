"""Document scores by prediction by partial matching, pretrained on the training documents.

A document is a sequence of bytes with an end symbol. The model is a trie of the byte contexts that precede each
symbol, up to `ORDER` bytes. A symbol that was seen in the longest known context is coded there; otherwise an
escape is coded and the next shorter context is asked, where the symbols of the longer one are excluded. The
escape estimate is method C: of n symbols seen in a context, d of them different, the escape has d / (n + d). Below the
empty context all symbols not seen at all are equally likely. So every document has a probability, and the
probabilities of the symbols after any context sum to 1.

Counts are taken over all training documents: those whose crc32(doc_id as text) mod 5 is not 1. Every context that
occurs in them is held, so the model grows with the corpus. No task holds all of it: a symbol's score depends on the
`ORDER` symbols before it alone, so each different context with its symbol (a gram) is scored once, in groups of the
contexts that share their last two symbols. Scores of the frequent grams are sent to all tasks (at most `FREQUENT`),
the others are joined, one row for each gram of a document. In a context's shorter one all of its symbols are known, so
what is excluded there is known from two sums a context.

`most` holds only the most frequent contexts instead, with their suffixes, which are at least as frequent; `automaton` is
the same model as a table of transitions, for few contexts.

Beside it there is a word model for comparison: see `scored`. Words and grams are counted per task before they are
shuffled; counts of frequent words are sent to all tasks (at most `FREQUENT`), the others are joined.

Edge cases: a null text is empty and consists of the end alone. A null doc_id belongs to the training documents.
Repeated rows count and are scored each. Without training documents all symbols are equally likely. An empty table
gives no rows. Words are told apart by 64-bit fingerprints. Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.llm.common import FINE, LOWER, UPPER, least_cell, most_frequent, prepare, stored

ORDER = 5
FREQUENT = 1 << 19
CHUNK = 512
#: Symbols or words that a task gathers before it counts them.
GATHERED = 1 << 21
#: Bytes of text that are scored at a time, but at least one text.
SCORED = 1 << 20
REMEMBERED = 1 << 18
END = 256
SYMBOLS = 257
_BITS = 9
_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: Fingerprint that stands for the end of a document among the words' ones.
_END_WORD = xxhash.xxh3_64_intdigest(b" ") - (1 << 63)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word) - (1 << 63)
        return value


def _word_keys(text: bytes, words: dict) -> np.ndarray:
    split = text.split()
    out = np.empty(len(split) + 1, dtype=np.int64)
    out[:-1] = np.fromiter(map(words.__getitem__, split), dtype=np.int64, count=len(split))
    out[-1] = _END_WORD
    return out


def context_keys(texts: list[bytes], order: int) -> np.ndarray:
    """For every symbol of every text the `order` symbols before it and the symbol, `_BITS` bits each."""
    sizes = np.array([len(t) + 1 + order for t in texts])
    symbols = np.full(sizes.sum(), END, dtype=np.int64)
    ends = np.cumsum(sizes)
    counted = np.ones(len(symbols), dtype=bool)
    for text, end, size in zip(texts, ends, sizes):
        symbols[end - size + order:end - 1] = np.frombuffer(text, dtype=np.uint8)
        counted[end - size:end - size + order] = False
    keys = np.zeros(len(symbols), dtype=np.int64)
    for back in range(order, -1, -1):
        keys[order:] = (keys[order:] << _BITS) | symbols[order - back:len(symbols) - back]
    return keys[counted]


def _counts(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    """(word, key, n): how often a word (by fingerprint) or a gram occurs in training; grams held out have a 0."""
    words = _Words()
    held: dict[str, list[np.ndarray]] = {"word": [], "gram": [], "other": []}

    def out(kind: str):
        keys, n = np.unique(np.concatenate(held[kind]), return_counts=True)
        held[kind] = []
        return pa.record_batch({
            "word": pa.array(np.full(len(keys), kind == "word")), "key": keys,
            "n": np.zeros(len(keys), dtype=np.int64) if kind == "other" else n.astype(np.int64)})

    for batch in batches:
        texts = [(t or b"").translate(_FOLD) for t in batch["text"].to_pylist()]
        apart = batch["held_out"].to_pylist()
        train, other = [t for t, o in zip(texts, apart) if not o], [t for t, o in zip(texts, apart) if o]
        if train:
            held["gram"].append(context_keys(train, order))
            held["word"].append(np.concatenate([_word_keys(t, words) for t in train]))
        if other:
            held["other"].append(np.unique(context_keys(other, order)))
        for kind in held:
            if sum(map(len, held[kind])) >= GATHERED:
                yield out(kind)
    for kind in held:
        if held[kind]:
            yield out(kind)


def _mask(symbols: int) -> int:
    return (1 << _BITS * symbols) - 1


def _places(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in the sorted `known`, whether it is there) of each wanted key."""
    if not len(known):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    place = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return place, known[place] == wanted


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, inverse = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(inverse, weights=n, minlength=len(distinct))


def gram_scores(
    keys: np.ndarray, n: np.ndarray, order: int, shared: list[tuple[np.ndarray, np.ndarray]], least: int | None = None
) -> np.ndarray:
    """log10 probability of each gram's symbol after its context.

    keys, n: all grams whose contexts share their last len(shared) symbols, with their counts. shared: for each
    shorter length of contexts, keys and counts of all contexts of it with their symbols. least: only contexts with such
    a `cell` of their count are held, and the empty one.
    """
    levels = []  # (entries, counts, contexts, totals, kinds, sum of the shorter context's counts of the same symbols)
    for k in range(order + 1):
        if k < len(shared):
            entry, count = shared[k]
        else:
            entry, count = _summed(keys[n > 0] & _mask(k + 1), n[n > 0])
        context, first = np.unique(entry >> _BITS, return_index=True)
        bounds = np.r_[first, len(entry)].astype(np.int64)
        total, kinds = np.diff(np.r_[0.0, np.cumsum(count)][bounds]), np.diff(bounds)
        same = np.zeros(len(context))
        if k:
            place, known = _places(levels[-1][0], entry & _mask(k))
            up = np.where(known, levels[-1][1][place], 0) if len(levels[-1][1]) else np.zeros(len(entry))
            same = np.diff(np.r_[0.0, np.cumsum(up)][bounds])
        levels.append((entry, count, context, total, kinds, same))
    chance = np.zeros(len(keys))
    done = np.zeros(len(keys), dtype=bool)
    gone, gone_kinds = np.zeros(len(keys)), np.zeros(len(keys), dtype=np.int64)  # what is excluded
    for k in range(order, -1, -1):
        entry, count, context, total, kinds, same = levels[k]
        if not len(context):
            continue
        place, here = _places(context, (keys >> _BITS) & _mask(k))
        if least is not None and k:
            step = 2.0 ** np.floor(np.log2(np.maximum(total, FINE) / FINE))
            here &= (np.ceil(total / step) * step >= least)[place]
        here &= ~done
        more = kinds[place] - gone_kinds
        below = total[place] - gone + np.where(kinds[place] == SYMBOLS, 0, more)
        at, seen = _places(entry, keys & _mask(k + 1))
        hit = here & seen
        chance[hit] += np.log10(count[at[hit]] / below[hit])
        missed = here & ~seen & (more > 0)
        chance[missed] += np.log10(more[missed] / below[missed])
        gone, gone_kinds = np.where(here, same[place], gone), np.where(here, kinds[place], gone_kinds)
        done |= hit
    chance[~done] -= np.log10(SYMBOLS - gone_kinds[~done])
    return chance


def scored_grams(grams: DataFrame, order: int, most: int | None = None) -> DataFrame:
    """(key, n, chance) of every gram (key, n), its key being the context and the symbol: see `gram_scores`."""
    def shorter(k: int) -> Column:
        return F.expr(f"shiftright(key, {_BITS})").bitwiseAND(F.lit(_mask(k)))

    trained = grams.where("n > 0")
    least = None
    if most is not None:
        lengths = [F.struct(F.lit(k).alias("k"), shorter(k).alias("context")) for k in range(1, order + 1)]
        totals = trained.select(F.explode(F.array(*lengths)).alias("c"), "n").groupBy("c").agg(F.sum("n").alias("n"))
        least = least_cell(totals, "n", most)
        least = np.inf if least is None else least
    common = min(order, 2)
    shared = []
    for k in range(common):  # at most SYMBOLS ** 2 rows
        table = trained.groupBy(F.col("key").bitwiseAND(F.lit(_mask(k + 1))).alias("key")).agg(
            F.sum("n").cast("double").alias("n")).toArrow().sort_by("key")
        shared.append((table["key"].to_numpy(), table["n"].to_numpy()))

    def of_group(group):  # Spark evaluates annotations
        keys, n = group["key"].to_numpy(), group["n"].to_numpy()
        return pa.table({"key": keys, "n": n, "chance": gram_scores(keys, n, order, shared, least)})

    return grams.groupBy(shorter(common).alias("last")).applyInArrow(of_group, "key long, n long, chance double")


def automaton(k: np.ndarray, context: np.ndarray, symbol: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(column of each symbol, next state by state and column, log10 probability by state and column).

    Entries must be sorted by k and context; state 0 is the empty context. Symbols that were never seen share one
    column, since they are equally likely everywhere. The last column is a blank that scores nothing.
    """
    firsts = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (context[1:] != context[:-1])][: len(k)])
    levels = k[firsts] if len(k) else np.array([0])
    contexts = context[firsts] if len(k) else np.array([0])
    owner = np.repeat(np.arange(len(levels)), np.diff(np.r_[firsts, len(k)])) if len(k) else np.array([], dtype=np.int64)
    known = np.unique(symbol)
    columns = np.full(SYMBOLS + 1, len(known), dtype=np.int64)
    columns[known] = np.arange(len(known))
    columns[SYMBOLS] = len(known) + 1
    follow = np.zeros((len(levels), len(known) + 2), dtype=np.int32)
    score = np.zeros((len(levels), len(known) + 2), dtype=np.float32)
    above = None
    with np.errstate(divide="ignore", invalid="ignore"):
        for level in range(int(levels.max()) + 1):
            here = np.flatnonzero(levels == level)
            lo, m = here[0], len(here)
            own = (owner >= lo) & (owner < lo + m)
            # The last column is that of the symbols never seen: never counted, one probability each.
            count = np.zeros((m, len(known) + 1))
            count[owner[own] - lo, columns[symbol[own]]] = n[own]
            seen = count > 0
            total, kinds = count.sum(1, keepdims=True), seen.sum(1, keepdims=True)
            if level == 0:
                below = np.full(count.shape, 1.0 / max(SYMBOLS - len(known), 1))
            else:
                parent = np.searchsorted(contexts[above[0]:above[0] + above[1]], contexts[here] & ((1 << _BITS * (level - 1)) - 1))
                up_count, up_below = above[2][parent], above[3][parent]
                left = np.where(seen, 0, up_count)  # what the parent knows beside this context's symbols
                more = (left > 0).sum(1, keepdims=True)
                full = (up_count > 0).sum(1, keepdims=True) == SYMBOLS  # nothing to escape to
                whole = left.sum(1, keepdims=True) + np.where(full, 0, more)
                below = np.where(left > 0, left / whole, np.where(more > 0, more / whole, 1.0) * up_below)
                follow[here] = follow[above[0] + parent]  # the longest held suffix, unless a longer context is held
            escape = np.where(kinds == SYMBOLS, 0, kinds)
            chance = np.where(seen, count / (total + escape), np.where(total > 0, escape / (total + escape), 1.0) * below)
            score[here, :-1] = np.log10(chance)
            longer = np.flatnonzero(levels == level + 1)
            prefix = lo + np.searchsorted(contexts[here], contexts[longer] >> _BITS)
            follow[prefix, columns[contexts[longer] & ((1 << _BITS) - 1)]] = longer
            above = (lo, m, count, below)
    follow[:, -1] = 0
    return columns, follow, score


def automaton_scores(
    texts: list[bytes], columns: np.ndarray, follow: np.ndarray, score: np.ndarray, order: int, chunk: int = CHUNK
) -> np.ndarray:
    """log10 probability of each text with its end."""
    pieces, owners = [], []
    for i, text in enumerate(texts):
        symbols = np.full(order + len(text) + 1, END, dtype=np.int16)
        symbols[order:-1] = np.frombuffer(text, dtype=np.uint8)
        for begin in range(order, len(symbols), chunk):
            pieces.append(symbols[begin - order:begin + chunk])
            owners.append(i)
    lengths = np.array([len(p) for p in pieces])
    by_length = np.argsort(-lengths, kind="stable")
    board = np.full((order + chunk, len(pieces)), SYMBOLS, dtype=np.int16)
    for column, p in enumerate(by_length):
        board[:lengths[p], column] = pieces[p]
    state = np.zeros(len(pieces), dtype=np.int64)
    total = np.zeros(len(pieces))
    sorted_lengths = lengths[by_length]
    board = columns[board].astype(np.int16)
    width = score.shape[1]
    follow, score = follow.ravel(), score.ravel()
    for step in range(order + chunk):
        active = np.searchsorted(-sorted_lengths, -step, side="left")
        if not active:
            break
        place = state[:active] * width + board[step, :active]
        if step >= order:
            total[:active] += score[place]
        state[:active] = follow[place]
    return np.bincount(np.array(owners)[by_length], weights=total, minlength=len(texts))


def _looked_up(each: list[np.ndarray], keys: np.ndarray, chances: np.ndarray):
    """(sum of the known chances, number of the known, the other keys, how often each) of every array of keys."""
    base, known, rare, times = [], [], [], []
    for own in each:
        distinct, n = np.unique(own, return_counts=True)
        place, found = _places(keys, distinct)
        base.append(float(chances[place[found]] @ n[found]))
        known.append(int(n[found].sum()))
        rare.append(distinct[~found])
        times.append(n[~found])
    return base, known, rare, times


def _scores(batches: Iterator[pa.RecordBatch], model, order: int) -> Iterator[pa.RecordBatch]:
    """Of the grams and the words those with frequent scores summed up and the others listed."""
    words = _Words()
    lists = pa.list_(pa.int64())
    for batch in batches:
        grams, gram_chances, keys, chances = model.value
        texts = [(t or b"").translate(_FOLD) for t in batch["text"].to_pylist()]
        begin = 0
        while begin < len(texts):
            end, size = begin + 1, len(texts[begin])
            while end < len(texts) and size + len(texts[end]) <= SCORED:
                size += len(texts[end])
                end += 1
            some = batch.slice(begin, end - begin)
            each = [_word_keys(t, words) for t in texts[begin:end]]
            base, known, rare, times = _looked_up(each, keys, chances)
            score, _, rare_grams, gram_times = _looked_up([context_keys([t], order) for t in texts[begin:end]], grams, gram_chances)
            yield pa.record_batch({
                "doc_id": some["doc_id"], "held_out": some["held_out"], "n_tokens": pa.array([len(w) for w in each], pa.int64()),
                "score": pa.array(score, pa.float64()), "base": pa.array(base, pa.float64()), "known": pa.array(known, pa.int64()),
                "rare": pa.array(rare, lists), "times": pa.array(times, lists),
                "rare_grams": pa.array(rare_grams, lists), "gram_times": pa.array(gram_times, lists)})
            begin = end


def scored(docs: DataFrame, order: int = ORDER, most: int | None = None, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of `docs` (doc_id, text).

    score: log10 probability of the text under the model. base_score: the same under a model of single words,
    with (count + 0.5) / (N + 0.5 (V + 1)) for each token; tokens are the words and one end, N their number in the training
    documents and V the number of different ones. n_known: tokens with a count.
    """
    spark = prepare(docs.sparkSession)
    texts = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("binary").alias("text"))
    counts = stored(
        texts.select("held_out", "text").mapInArrow(partial(_counts, order=order), "word boolean, key long, n long")
        .groupBy("word", "key").agg(F.sum("n").alias("n")), "counts")
    of_words = counts.where("word").select("key", "n")
    total, different = of_words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    below = total + 0.5 * (different + 1)
    common = most_frequent(of_words, "n", frequent).toArrow().sort_by("key")
    keys, chances = common["key"].to_numpy(), np.log10((common["n"].to_numpy() + 0.5) / below)
    of_grams = stored(scored_grams(counts.where("not word").select("key", "n"), order, most), "grams")
    common = most_frequent(of_grams, "n", frequent).select("key", "chance").toArrow().sort_by("key")
    model = spark.sparkContext.broadcast((common["key"].to_numpy(), common["chance"].to_numpy(), keys, chances))
    rows = stored(texts.mapInArrow(
        partial(_scores, model=model, order=order),
        "doc_id long, held_out boolean, n_tokens long, score double, base double, known long, rare array<long>, times array<long>, "
        "rare_grams array<long>, gram_times array<long>",
    ).withColumn("row", F.monotonically_increasing_id()), "scores")

    def listed(keys: str, times: str) -> DataFrame:
        return rows.select("row", F.explode(F.arrays_zip(F.col(keys).alias("key"), F.col(times).alias("times"))).alias("r")).select("row", "r.key", "r.times")

    chance = F.log10((F.coalesce("n", F.lit(0)) + 0.5) / F.lit(below))
    rest = listed("rare", "times").join(of_words, "key", "left").groupBy("row").agg(
        F.sum(F.col("times") * chance).alias("more"), F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("also"))
    # Every gram of a document has a score, whether it occurs in training or not.
    rest_grams = listed("rare_grams", "gram_times").join(of_grams.select("key", "chance"), "key").groupBy("row").agg(
        F.sum(F.col("times") * F.col("chance")).alias("more_score"))
    return rows.drop("rare", "times", "rare_grams", "gram_times").join(rest, "row", "left").join(rest_grams, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("also", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"))
