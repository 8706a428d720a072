"""Language of a text by averaged hashed subword embeddings and a linear softmax.

Words are runs of letters, lower-cased, with a mark before and after. Every stretch of `LEAST_GRAM` to `MOST_GRAM`
characters of a marked word is hashed to one of 2 ** `BITS` embeddings; a text is the mean of its embeddings, and
a linear softmax over the learned languages follows. Embeddings and softmax are trained together by stochastic
gradient descent in numpy, on a sample of about `LABELLED` labelled documents, shared evenly among the languages
and picked by a hash (equal documents count once). Every sampled document gives its whole text and `PIECES` short
stretches of it, so that short texts are learned as well. Counts of its grams, at most 2 ** `BITS` numbers
a document, are what reaches the driver.

Calibration: a fifth of the sampled documents is held back. A temperature that fits their likelihood best turns
the softmax into probabilities, and the cutoff is the least probability at and above which at most `MOST_WRONG` of the
held back predictions are wrong. A prediction below it is `rejected`; its likeliest language is still given.

The model doesn't depend on the number of documents, and goes to the tasks as one array. Texts are read whole,
in steps of `STEP` characters.

Edge cases: null texts and texts without letters are `und` with score 0, and rejected. Rows without lang or of the held
out third teach nothing. Without any labelled row everything is `und`. Rows without doc_id count as those whose doc_id
is the empty text. Repeated rows are predicted each. An empty table gives no rows. Other columns are not looked at.
Languages are assumed to be few: their list is on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from farelake.llm.common import prepare

UNKNOWN = "und"
BITS = 15
DIMENSIONS = 16
LEAST_GRAM, MOST_GRAM = 2, 4
#: Documents of the training sample, over all languages.
LABELLED = 2000
#: Short stretches of a sampled document, and their words.
PIECES, PIECE_WORDS = 3, 6
EPOCHS, RATE, SEED = 5, 4.0, 17
#: Share of wrong predictions among those that aren't rejected.
MOST_WRONG = 0.01
#: Documents are held out if crc32(doc_id) leaves this remainder.
FOLDS, HELD_OUT = 3, 1
STEP = 1 << 16

_SEPARATOR = "\n"


@dataclass(frozen=True)
class Model:
    """table: what a gram adds to each language's log odds."""

    languages: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    cutoff: float


@cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts, zero for anything else, with a zero before each text; where each text begins."""
    lowered = [_SEPARATOR + text.lower() for text in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.where(_letters()[codes], codes, 0).astype(np.uint64)
    lengths = np.fromiter(map(len, lowered), dtype=np.int64, count=len(texts))
    return np.append(codes, np.zeros(MOST_GRAM, np.uint64)), np.cumsum(lengths) - lengths


def _grams(codes: np.ndarray, start: int, stop: int) -> Iterator[np.ndarray]:
    """Per gram length, the buckets of the grams beginning in [start, stop); 2 ** BITS where there is none."""
    step = codes[start:stop + MOST_GRAM]
    n = stop - start
    letter = step != 0
    value, inside = step[:n], np.ones(n, dtype=bool)
    for length in range(2, MOST_GRAM + 1):
        value = value * np.uint64(0x100000001B3) + step[length - 1:n + length - 1]
        if length > 2:
            inside = inside & letter[length - 2:n + length - 2]
        held = inside if length > 2 else letter[:n] | letter[1:n + 1]
        if length >= LEAST_GRAM:
            mixed = (value + np.uint64(length)) * np.uint64(0x9E3779B97F4A7C15)
            yield np.where(held, (mixed >> np.uint64(64 - BITS)).astype(np.int64), 1 << BITS)


def gram_counts(text: str) -> np.ndarray:
    """Occurrences of each bucket in a text."""
    codes, _ = _codes([text])
    counts = np.zeros((1 << BITS) + 1, dtype=np.int64)
    n = len(codes) - MOST_GRAM
    for start in range(0, n, STEP):
        for buckets in _grams(codes, start, min(n, start + STEP)):
            counts += np.bincount(buckets, minlength=len(counts))
    return counts[:-1]


def log_odds(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of every language, a row per text, and the texts' numbers of grams."""
    codes, starts = _codes(texts)
    table = np.vstack([model.table, np.zeros((1, len(model.languages)), model.table.dtype)])
    sums = np.zeros((len(texts), len(model.languages)))
    counts = np.zeros(len(texts), dtype=np.int64)
    n = len(codes) - MOST_GRAM
    for start in range(0, n, STEP):
        stop = min(n, start + STEP)
        first, last = np.searchsorted(starts, start, "right") - 1, np.searchsorted(starts, stop, "left")
        cuts = np.maximum(starts[first:last], start) - start
        for buckets in _grams(codes, start, stop):
            sums[first:last] += np.add.reduceat(table[buckets], cuts, axis=0)
            counts[first:last] += np.add.reduceat((buckets < 1 << BITS).astype(np.int64), cuts)
    return sums / np.maximum(counts, 1)[:, None] + model.bias, counts


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(examples: list[tuple[str, int, np.ndarray, np.ndarray]]) -> Model:
    """A model of (language, document, buckets, counts) examples; the same for the same examples in any order."""
    examples = sorted(examples, key=lambda x: (x[0], x[1], len(x[2]), x[2].tobytes(), x[3].tobytes()))
    languages = tuple(sorted({x[0] for x in examples}))
    number = {language: i for i, language in enumerate(languages)}
    back = [x for x in examples if x[1] % 5 == 0]
    taught = [x for x in examples if x[1] % 5]
    if {x[0] for x in taught} != set(languages):  # too few documents to hold any back
        taught = examples
    rng = np.random.default_rng(SEED)
    embeddings = rng.uniform(-1, 1, (1 << BITS, DIMENSIONS)) / DIMENSIONS
    softmax, bias = np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages))
    shares = [counts / counts.sum() for *_, counts in taught]
    steps, total = 0, max(1, EPOCHS * len(taught))
    for _ in range(EPOCHS):
        for i in rng.permutation(len(taught)):
            language, _, buckets, _ = taught[i]
            rate = RATE * (1 - steps / total)
            steps += 1
            mean = shares[i] @ embeddings[buckets]
            wrong = _softmax(mean @ softmax + bias)
            wrong[number[language]] -= 1
            back_to_mean = softmax @ wrong
            softmax -= rate * np.outer(mean, wrong)
            bias -= 0.01 * rate * wrong
            embeddings[buckets] -= rate * np.outer(shares[i], back_to_mean)
    table = embeddings @ softmax
    if not back:
        return Model(languages, table.astype(np.float32), bias, 1.0, 0.0)
    odds = np.array([counts / counts.sum() @ table[buckets] + bias for _, _, buckets, counts in back])
    truth = np.array([number[x[0]] for x in back])
    cold = [2.0 ** (k / 4) for k in range(-16, 17)]
    loss = [-np.log(np.maximum(_softmax(odds / t)[np.arange(len(back)), truth], 1e-12)).mean() for t in cold]
    temperature = cold[int(np.argmin(loss))]
    chances = _softmax(odds / temperature)
    order = np.argsort(-chances.max(axis=1), kind="stable")
    wrong = np.cumsum(chances.argmax(axis=1)[order] != truth[order])
    fine = np.flatnonzero(wrong <= MOST_WRONG * np.arange(1, len(back) + 1))
    cutoff = float(chances.max(axis=1)[order][fine[-1]]) if len(fine) else 1.0
    return Model(languages, table.astype(np.float32), bias, temperature, cutoff)


def _pieces(text: str, key: int) -> list[str]:
    words = text.split()
    if len(words) <= PIECE_WORDS:
        return []
    rng = np.random.default_rng(key % (1 << 32))
    return [" ".join(words[i:i + PIECE_WORDS]) for i in rng.integers(0, len(words) - PIECE_WORDS, PIECES)]


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for language, key, text in zip(*(batch[c].to_pylist() for c in ("lang", "key", "text"))):
            found = [gram_counts(part) for part in [text, *_pieces(text, key)]]
            held = [np.flatnonzero(counts) for counts in found]
            some = [(buckets, counts[buckets]) for buckets, counts in zip(held, found) if len(buckets)]
            yield pa.record_batch({
                "lang": pa.array([language] * len(some), pa.string()),
                "key": pa.array([key] * len(some), pa.int64()),
                "buckets": pa.array([b.astype(np.int32).tobytes() for b, _ in some], pa.binary()),
                "counts": pa.array([c.astype(np.int32).tobytes() for _, c in some], pa.binary()),
            })


def held_out() -> F.Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS == HELD_OUT


def sampled(docs: DataFrame, most: int = LABELLED) -> DataFrame:
    """(lang, key, text) of about `most` different labelled documents that aren't held out, languages in even shares."""
    known = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & ~held_out())
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    if not sizes:
        return known.select("lang", F.lit(0).cast("long").alias("key"), "text").limit(0)
    share = most / len(sizes)
    picked = docs.sparkSession.createDataFrame(
        [(r["lang"], int(min(1.0, share / r["n"]) * (1 << 32))) for r in sizes], "lang string, least long")
    key = F.pmod(F.xxhash64("doc_id", "text", "lang"), F.lit(1 << 32))
    return known.where(F.col("text").isNotNull()).withColumn("key", key).join(
        F.broadcast(picked), "lang").where("key < least").groupBy("lang", "key").agg(F.min("text").alias("text"))


def fitted(docs: DataFrame, most: int = LABELLED) -> Model:
    rows: list[Row] = sampled(docs, most).mapInArrow(
        _examples, "lang string, key long, buckets binary, counts binary").collect()
    return fit([(r["lang"], r["key"], np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["counts"], np.int32))
                for r in rows])


def predicted(texts: list[str | None], model: Model) -> list[tuple[str, float, bool]]:
    """(language, probability, rejected) of each text."""
    if not model.languages:
        return [(UNKNOWN, 0.0, True)] * len(texts)
    odds, counts = log_odds([text or "" for text in texts], model)
    chances = _softmax(odds / model.temperature)
    best = chances.argmax(axis=1)
    return [(model.languages[b], float(c[b]), bool(c[b] < model.cutoff)) if n else (UNKNOWN, 0.0, True)
            for b, c, n in zip(best, chances, counts)]


def _identified(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch["text"].to_pylist()
        found, group, size = [], [], 0
        for text in texts:
            group.append(text)
            size += len(text or "")
            if size >= STEP:
                found += predicted(group, model)
                group, size = [], 0
        found += predicted(group, model) if group else []
        yield pa.record_batch({
            "doc_id": batch["doc_id"],
            "held_out": batch["held_out"],
            "lang_pred": pa.array([x[0] for x in found], pa.string()),
            "score": pa.array([x[1] for x in found], pa.float64()),
            "rejected": pa.array([x[2] for x in found], pa.bool_()),
        })


def identified(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of every document; the model is fitted on `docs` if none is given."""
    prepare(docs.sparkSession)
    model = model or fitted(docs)
    return docs.select("doc_id", "text", held_out().alias("held_out")).mapInArrow(
        partial(_identified, model=model),
        "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
