"""Quality rules whose cutoffs come with a guarantee.

Every document gets counts (`features`). A rule rejects a document if one of its `RULES` values lies above the
cutoff of its stratum (its language). The cutoffs are found on labelled documents that no rule was made
from: a cutoff may be used only if the share of good documents it would reject is below the rule's part of `total_risk`,
shown by an exact binomial test on the good documents of the stratum.

Multiple testing: the candidates of one rule and stratum are tested from loose to tight and the testing ends
at the first one that isn't proven (fixed-sequence testing). The level is divided evenly among the strata (Bonferroni), and
inside a stratum both its level and `total_risk` are divided among the rules by weight: how many bad documents the tightest
candidate rejects. The weights come from bad documents and the tests from good ones, so the weights don't disturb them; a rule
that rejects no bad document costs the others nothing. With probability 1 - `level`, all cutoffs in use hold at once, in
every stratum. So in each stratum all rules together reject less than `total_risk` of good documents. Of the proven
cutoffs, the one with the most bad less good documents rejected is used, the looser one on ties.

Languages with too few good documents to prove anything alone are pooled to one stratum (too few is told by their number
alone), for which the guarantee holds as a whole. If that is too small, too, and for a language without any label, there
is no cutoff, and documents are kept unless the base rule fails.

Everything is built-in DataFrame functions. Whole texts are used. Windows of words are compared by 64-bit
fingerprints within a document.

Edge cases: a null text has no words, so the base rule fails. Texts without words likewise. A null language is a
stratum of its own. Repeated rows each get their verdict; a repeated label counts once, the worse quality holding.
Labels without a quality are ignored. With no labels at all, the base rule alone decides. Input columns of the
same name as a feature are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelake.llm.common import SPACE, prepare, stored, words

WINDOW = 5
TOTAL_RISK = 0.02
LEVEL = 0.05

#: Rule: (value, candidates from loose to tight). A value above the cutoff rejects.
RULES: dict[str, tuple[str, list[float]]] = {
    "symbols": ("n_symbols / greatest(word_chars, 1)", [0.5, 0.3, 0.2, 0.15, 0.1, 0.05, 0.02, 0.01]),
    "capitals": ("n_capitals / greatest(word_chars, 1)", [0.9, 0.7, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1]),
    "shouting": ("n_exclamations / greatest(word_chars, 1)", [0.5, 0.3, 0.2, 0.1, 0.05, 0.02]),
    "same_lines": ("n_dup_lines / greatest(n_lines, 1)", [0.8, 0.6, 0.4, 0.3, 0.2, 0.1]),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", [0.19, 0.15, 0.1, 0.05]),
    "long_words": ("word_chars / greatest(n_words, 1)", [30.0, 20.0, 15.0, 12.0, 10.0, 9.0]),
}
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_ALL = [*BASE, "n_lines", "n_capitals", "n_exclamations"]


def _without(text: str, pattern: str) -> Column:
    """Number of characters of `text` that match a class."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def features(docs: DataFrame) -> DataFrame:
    """`docs` with the counts of `_ALL` and base_failed."""
    df = docs.drop(*_ALL, "base_failed").withColumn("_t", F.coalesce("text", F.lit(""))).withColumn("_w", words(F.col("_t")))
    df = df.withColumns({
        "_n": F.size("_w"),
        "_h": F.transform("_w", lambda w: F.xxhash64(w)),
        "_lines": F.filter(F.split("_t", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
        "word_chars": F.length(F.array_join("_w", "")).cast("long"),
        "n_symbols": _without("_t", "[#*$%&|<>]+"),
        "n_capitals": _without("_t", r"\p{Lu}+"),
        "n_exclamations": _without("_t", "!+"),
    }).drop("_w", "_t")
    windows = F.transform(
        F.sequence(F.lit(0), F.col("_n") - WINDOW), lambda i: F.xxhash64(*(F.get("_h", i + k) for k in range(WINDOW))))
    df = df.withColumns({
        "n_words": F.col("_n").cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_x": F.when(F.col("_n") >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")),
    }).drop("_lines", "_h", "_n")
    # Only texts with an equal pair of windows are sorted.
    some = F.size(F.array_distinct("_x")) < F.size("_x")
    df = df.withColumn("_s", F.when(some, F.array_sort(F.transform("_x", lambda x, i: F.struct(x.alias("x"), i.alias("i")))))).drop("_x")
    twice = F.filter("_s", lambda a, i: (a["x"] == F.get("_s", i - 1)["x"]) | (a["x"] == F.get("_s", i + 1)["x"]))
    df = df.withColumn("_p", F.array_sort(F.transform(twice, lambda a: a["i"]))).drop("_s")
    covered = F.transform("_p", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_p", i + 1) - p, F.lit(WINDOW))))
    df = df.withColumn("n_repeat_words", F.coalesce(
        F.aggregate(covered, F.lit(0).cast("long"), lambda a, b: a + b), F.lit(0).cast("long"))).drop("_p")
    return df.withColumn(
        "base_failed", (F.col("n_words") < 10) | (F.lit(100) * F.col("n_repeat_words") > F.lit(20) * F.col("n_words")))


def _log_factorial(x: Column) -> Column:
    """ln(x!) by Stirling's series, shifted so that it is exact to double precision for small x, too."""
    z = x.cast("double") + 1
    y = z + 7
    product = z
    for k in range(1, 7):
        product = product * (z + k)
    return ((y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y)
            + 1 / (1260 * y * y * y * y * y) - F.log(product))


def binomial_tail(k: Column, n: Column, p: Column) -> Column:
    """P(X <= k) for X of n trials of probability p, for k below n p; 1 from there on.

    The terms are summed downwards from k. They fall like a normal density, so those further than twenty
    standard deviations away are below double precision.
    """
    k, n = k.cast("double"), n.cast("double")
    first = (_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * F.log(p) + (n - k) * F.log1p(-p))
    many = F.least(k, F.ceil(20 * F.sqrt(n * p)) + 100).cast("int")
    terms = F.aggregate(
        F.sequence(F.lit(0), many - 1), F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s")),
        lambda a, j: F.struct(
            (a["t"] * (k - j) * (1 - p) / ((n - k + j + 1) * p)).alias("t"),
            (a["s"] + a["t"] * (k - j) * (1 - p) / ((n - k + j + 1) * p)).alias("s")),
        lambda a: a["s"])
    return F.when(k >= n * p, 1.0).otherwise(F.exp(first) * F.when(k > 0, terms).otherwise(1.0))


def cutoffs(featured: DataFrame, labels: DataFrame, total_risk: float = TOTAL_RISK, level: float = LEVEL) -> DataFrame:
    """(stratum, cutoffs map<rule, double>) proven on the labelled documents that pass the base rule.

    featured: doc_id, lang and `features`; labels: doc_id, quality (1 good, 0 bad).
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("_q"))
    held = featured.where("not base_failed").join(known, "doc_id")
    good, bad = F.col("_q") == 1, F.col("_q") == 0
    counts = [
        F.struct(F.lit(rule).alias("rule"), F.lit(step).alias("step"), F.lit(cutoff).alias("cutoff"),
                 F.count_if(good & (F.expr(value) > cutoff)).alias("good"),
                 F.count_if(bad & (F.expr(value) > cutoff)).alias("bad"))
        for rule, (value, grid) in RULES.items() for step, cutoff in enumerate(grid)
    ]
    strata = stored(held.groupBy(F.col("lang").alias("stratum")).agg(
        F.count_if(good).alias("n"), *(c.alias(f"_{i}") for i, c in enumerate(counts))), "strata")
    # Not even a cutoff that rejects no good document could be proven.
    small = F.pow(F.lit(1 - total_risk), "n") > level / max(strata.count(), 1)
    homes = strata.withColumn("home", F.struct(small.alias("pooled"), F.when(~small, F.col("stratum")).alias("own")))
    # All that follows goes by home or finer, so one exchange of a row per stratum serves it.
    totals = homes.groupBy("home").agg(F.sum("n").alias("n"), *(
        F.struct(*(F.first(f"_{i}.{c}").alias(c) for c in ("rule", "step", "cutoff")),
                 *(F.sum(f"_{i}.{c}").alias(c) for c in ("good", "bad"))).alias(f"_{i}") for i in range(len(counts))))
    rule = ["home", "rule"]
    one = totals.select("home", "n", F.explode(F.array(*(f"_{i}" for i in range(len(counts))))).alias("c")).select(
        "home", "n", "c.*").withColumn("hits", F.max("bad").over(Window.partitionBy(*rule)))
    all_hits = F.sum(F.when(F.col("step") == 0, F.col("hits"))).over(Window.partitionBy("home"))
    one = one.withColumn("weight", F.col("hits") / F.nullif(all_hits, F.lit(0))).where("hits > 0")
    homes_level = level / max(homes.select("home").distinct().count(), 1)
    proven = binomial_tail(F.col("good"), F.col("n"), total_risk * F.col("weight")) <= homes_level * F.col("weight")
    per = one.withColumn("proven", proven).groupBy(*rule).agg(
        F.array_sort(F.collect_list(F.struct("step", "proven", (F.col("bad") - F.col("good")).alias("net"), "cutoff"))).alias("c"))
    broken = F.array_position(F.transform("c", lambda x: x["proven"]), False)
    usable = F.slice("c", 1, F.when(broken == 0, F.size("c")).otherwise(broken - 1).cast("int"))
    best = F.array_max(F.transform(usable, lambda x: F.struct(x["net"], -x["step"], x["cutoff"])))
    found = (
        per.select(*rule, best["cutoff"].alias("cutoff")).where("cutoff is not null")
        .groupBy("home").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))
    )
    return homes.select("stratum", "home").join(found, "home").select("stratum", "cutoffs")


def judged(featured: DataFrame, found: DataFrame) -> DataFrame:
    """`featured` with the column kept."""
    found = found.select(F.col("stratum").alias("_stratum"), F.col("cutoffs").alias("_cutoffs"))
    rejected = F.lit(False)
    for rule, (value, _) in RULES.items():
        rejected = rejected | F.coalesce(F.expr(value) > F.col("_cutoffs")[rule], F.lit(False))
    return featured.join(found, F.col("lang").eqNullSafe(F.col("_stratum")), "left").withColumn(
        "kept", ~F.col("base_failed") & ~rejected).drop("_stratum", "_cutoffs")


def quality_verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) of every row."""
    prepare(docs.sparkSession)
    featured = stored(features(docs.select("doc_id", "text", "lang")).drop("text"), "features")
    found = stored(cutoffs(featured, labels), "cutoffs")
    return judged(featured, found).select("doc_id", *BASE, "base_failed", "kept")


def quality_filter(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that are kept, with their columns.

    The counted table is stored before it is judged: a filter over expressions of this size, pushed down through
    them, would make a plan that takes minutes to build.
    """
    prepare(docs.sparkSession)
    own = ("doc_id", "text", "lang")
    rest = [c for c in docs.columns if c not in own]
    quoted = ["`" + c.replace("`", "``") + "`" for c in rest]
    packed = docs.select(*own, *([F.struct(*quoted).alias("_rest")] if rest else []))
    counted = stored(features(packed), "counted")
    found = stored(cutoffs(counted, labels), "cutoffs")
    kept = judged(counted, found).where("kept")
    return kept.select(*(c if c in own else F.col("_rest").getField(c).alias(c) for c in docs.columns))
