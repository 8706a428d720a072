"""Mixing sources to target weights by a low-discrepancy schedule.

Sources, in order of their names by code point with null last, weigh 1, 2, 3, 1, ... and share all words by
weight; no target exceeds `MOST` times its source's own words, and what is above is shared among the others.

The mix is a sequence of slots of `BLOCK` words. Slot i goes to the source in whose interval of cumulative target
shares the fractional part of i times the golden ratio falls, so every stretch of the mix, not only the
whole, has the sources near their weights. The k-th slot of a source takes the k-th block of its documents, which
are laid end to end in shuffled order; past the end they are laid out again. The schedule fills a source to
within a few blocks of its target; slots at its end make that good, and the last block of a source is cut
at its target, so the words taken differ from the target by less than one.

Everything is built-in DataFrame functions. Running sums go by slices of each source, so a source with a
third of all rows is many tasks; only slice totals meet in one.

A document's place is where its first words come: `first_slot`, the slot of the block it begins in, null if nothing of it is taken.
`mixed_documents` can return it, and for a further copy the slot of that copy, so that sorting by it gives the mix.

Edge cases: a null text has size 0; documents of size 0 take no part and count as taken 0. Repeated rows are laid
out each. Documents are shuffled by doc_id and text, so rows without doc_id, or with the same, spread as well. A table without words has targets of 0 and an empty schedule.
Other columns of the input are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelake.llm.common import prepare, stored, words

BLOCK = 256
#: A source is used at most so many times over.
MOST = 3
SEED = "mix"
SLICE_ROWS = 50_000
SLOTS_OF_CHUNK = 1 << 16
#: The unit interval is cut into so many cells, by which slots meet the sources' intervals.
CELLS = 4096
GOLDEN = (math.sqrt(5) - 1) / 2


def shuffle_key(doc_id: Column, text: Column) -> Column:
    return F.md5(F.concat(F.lit(SEED), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))))


def slice_of(key: Column, slices: int) -> Column:
    """Number of the slice of an MD5 value; slices are ranges of it."""
    return F.floor(F.conv(F.substring(key, 1, 6), 16, 10).cast("long") * slices / F.lit(1 << 24))


def sizes(docs: DataFrame, *more: Column) -> DataFrame:
    """(doc_id, source, size, key) of every document, and `more` columns; key decides its place in its source."""
    size = F.size(words(F.col("text"))).cast("long")
    return docs.select("doc_id", "source", size.alias("size"), shuffle_key(F.col("doc_id"), F.col("text")).alias("key"), *more)


def targets(sized: DataFrame) -> DataFrame:
    """(source, source_no, source_size, target) by filling up the shares until every cap holds.

    With the sources sorted by cap / weight, those before some place are at their cap and those from there
    on get equal shares per weight. The first place whose own share stays below its cap is the right one.
    """
    everything = Window.partitionBy()
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = sources.withColumn("source_no", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))).cast("long"))
    sources = sources.withColumn("weight", (F.col("source_no") - 1) % 3 + 1).withColumn("cap", F.col("source_size") * MOST)
    order = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    sources = sources.withColumn("share", left / weight).withColumn("place", F.row_number().over(order))
    fits = F.when(F.col("share") * F.col("weight") <= F.col("cap"), F.col("place"))
    per_weight = F.min(F.struct(fits.isNull().alias("no"), fits.alias("place"), F.col("share"))).over(everything)["share"]
    return sources.withColumn("target", F.least(F.col("cap").cast("double"), per_weight * F.col("weight"))).select(
        "source", "source_no", "source_size", "target")


def schedule(mix: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slot, source_no, block_no): which block of which source comes when."""
    spark = mix.sparkSession
    total = mix.agg(F.sum("target")).first()[0] or 0
    count = math.ceil(total / block)
    mix = mix.where("target > 0").withColumn("blocks", F.ceil(F.round("target") / block))
    upper = F.sum("target").over(Window.orderBy("source_no")) / F.lit(total or 1.0)
    ranges = mix.withColumn("hi", upper).withColumn("lo", F.coalesce(F.lag("hi").over(Window.orderBy("source_no")), F.lit(0.0)))
    last = F.row_number().over(Window.orderBy(F.desc("source_no"))) == 1
    ranges = ranges.withColumn("hi", F.when(last, 1.0).otherwise(F.col("hi")))  # whatever the rounding
    cells = ranges.select("source_no", "blocks", "lo", "hi", F.explode(
        F.sequence(F.floor(F.col("lo") * CELLS), F.least(F.floor(F.col("hi") * CELLS), F.lit(CELLS - 1)))).alias("cell"))
    point = (F.col("slot") * F.lit(GOLDEN)) % 1
    slots = spark.range(count).withColumnRenamed("id", "slot").withColumn("point", point).withColumn(
        "cell", F.floor(F.col("point") * CELLS))
    slots = slots.join(cells, "cell").where("point >= lo and point < hi").select(
        "slot", "source_no", "blocks", F.floor(F.col("slot") / SLOTS_OF_CHUNK).alias("chunk"))
    ahead = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = slots.groupBy("source_no", "chunk").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("source_no", "chunk").orderBy("slot")) - 1
    ranked = slots.withColumn("rank", rank).join(chunks, ["source_no", "chunk"]).select(
        "slot", "source_no", "blocks", (F.col("ahead") + F.col("rank")).alias("block_no")).where("block_no < blocks")
    held = chunks.groupBy("source_no").agg(F.sum("n").alias("held"))
    missing = mix.join(held, "source_no", "left").where("coalesce(held, 0) < blocks").select(
        "source_no", F.explode(F.sequence(F.coalesce("held", F.lit(0)), F.col("blocks") - 1)).alias("block_no"))
    tail = missing.withColumn("slot", count - 1 + F.row_number().over(Window.orderBy("block_no", "source_no")))
    return ranked.select("slot", "source_no", "block_no").unionByName(tail)


def laid_out(sized: DataFrame, mix: DataFrame) -> DataFrame:
    """(doc_id, size, key columns, source_no, source_size, target, start): `start` words of its source lie before it.

    `sized` may have further columns. Its rows must be stored, since they are read twice.
    """
    slices = max(1, math.ceil(sized.count() / SLICE_ROWS))
    named = mix.select(F.col("source").alias("_source"), "source_no", "source_size", "target")
    rows = sized.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn(
        "_slice", slice_of(F.col("key"), slices))
    ahead = Window.partitionBy("source_no").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("source_no", "_slice").agg(F.sum("size").alias("_words")).withColumn(
        "_ahead", F.coalesce(F.sum("_words").over(ahead), F.lit(0))).drop("_words")
    ties = [c for c in sized.columns if c not in ("key", "source")]
    inside = Window.partitionBy("source_no", "_slice").orderBy("key", *ties).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("_before", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        offsets, ["source_no", "_slice"]).withColumn("start", F.col("_ahead") + F.col("_before")).drop(
        "key", "_slice", "_before", "_ahead")


def pieces(rows: DataFrame, slots: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix: `rows` by slot, with the words [first_word, end_word) of the document and the pass over its source."""
    filled = F.round("target").cast("long")
    passes = rows.where("size > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(MOST - 1)))).withColumn(
        "_from", F.col("pass") * F.col("source_size") + F.col("start")).where(F.col("_from") < filled)
    passes = passes.withColumn("_to", F.least(F.col("_from") + F.col("size"), filled)).withColumn(
        "block_no", F.explode(F.sequence(F.floor(F.col("_from") / block), F.floor((F.col("_to") - 1) / block))))
    return passes.join(slots, ["source_no", "block_no"]).withColumns({
        "first_word": F.greatest(F.col("block_no") * block, F.col("_from")) - F.col("_from"),
        "end_word": F.least((F.col("block_no") + 1) * block, F.col("_to")) - F.col("_from"),
    }).drop("_from", "_to")


def mixed_words(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, size, source_size, target, taken, first_slot) of every row of `docs` (doc_id, source, text)."""
    prepare(docs.sparkSession)
    sized = stored(sizes(docs), "sizes")
    mix = stored(targets(sized), "targets")
    rows = stored(laid_out(sized, mix), "laid-out")
    taken = pieces(rows, stored(schedule(mix, block), "schedule"), block).groupBy(
        "source_no", "start", "doc_id", "size", "source_size", "target").agg(
        F.sum(F.col("end_word") - F.col("first_word")).alias("taken"), F.min("slot").alias("first_slot"))
    untouched = rows.where((F.col("size") == 0) | (F.col("start") >= F.round("target").cast("long")))
    columns = ["doc_id", "size", "source_size", "target"]
    nothing = (F.lit(0).cast("long").alias("taken"), F.lit(None).cast("long").alias("first_slot"))
    return taken.select(*columns, "taken", "first_slot").unionByName(untouched.select(*columns, *nothing))


def _row_key(docs: DataFrame) -> Column:
    """Fingerprint of a whole row, whatever its columns are called."""
    quoted = {c: "`" + c.replace("`", "``") + "`" for c in docs.columns}
    own = ("source", "doc_id", "text")
    rest = [F.col(quoted[c]) for c in docs.columns if c not in own]
    return F.md5(F.to_json(F.struct(*(F.md5(F.col(c).cast("string")).alias(c) for c in own), F.struct(F.lit(0), *rest).alias("rest")), {"ignoreNullFields": "false"}))


def mixed_documents(docs: DataFrame, block: int = BLOCK, slot: str | None = None) -> DataFrame:
    """The rows of `docs` as often as the mix takes them, with their columns, and as column `slot`, if named, where.

    Documents stay whole: a pass gives a copy if it takes at least half of the document's words, which matters
    for the one document per source that the target cuts.
    """
    prepare(docs.sparkSession)
    name = "_" * (1 + max((len(c) for c in docs.columns), default=0))  # longer than any column's name
    keyed = docs.withColumn(name, _row_key(docs))
    sized = stored(sizes(keyed, F.col(name).alias("row")), "sizes")
    mix = stored(targets(sized), "targets")
    rows = stored(laid_out(sized, mix), "laid-out")
    copies = (
        pieces(rows, stored(schedule(mix, block), "schedule"), block)
        .groupBy("source_no", "start", "pass", "row", "size")
        .agg(F.sum(F.col("end_word") - F.col("first_word")).alias("taken"), F.min("slot").alias("slot"))
        .where("2 * taken >= size").select(F.col("row").alias(name), F.col("slot").alias(name + "s"))
    )
    # Equal rows are one row taken more often. The few columns of `copies` may be skewed by them; the join splits those.
    once = keyed.dropDuplicates([name])
    quoted = ["`" + c.replace("`", "``") + "`" for c in docs.columns]
    return once.join(copies, name).select(*quoted, *([F.col(name + "s").alias(slot)] if slot else []))
