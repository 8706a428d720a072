"""Keyed upsert: matching rows are replaced, new ones inserted.

There is no transactional table format here, so a merge rewrites the partitions its source touches. Spark
commits a dynamic overwrite partition by partition: a driver lost in the middle of the commit can
leave some months new and some old. Running the same merge again, with the same source, completes it; which source that
is must not be derived from the half-written table (see `sources.state`).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.session import scratch_path
from farelake.sources.tables import CLUSTER_COLUMNS, path_exists, write_clustered

POLICIES = ("error", "error_any", "keep_one")
#: So many keys are sent to every task to tell their copies from other rows; 8 MB for keys of one number.
FEW_KEYS = 500_000


def _known(keys: Sequence[str]) -> Column:
    return reduce(and_, (F.col(k).isNotNull() for k in keys))


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one source row. NULL keys equal nothing, so they are never duplicates."""
    counted = source.filter(_known(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return counted.filter(F.col("copies") > 1).select(*keys)


def _greatest(known: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    rest = [c for c in known.columns if c not in keys]
    order = [*newest, *[c for c in rest if c not in newest]]
    chosen = known.groupBy(*keys).agg(F.max(F.struct(*order)).alias("row"))
    return chosen.select(*[F.col(k) if k in keys else F.col(f"row.{k}").alias(k) for k in known.columns])


def keep_one(source: DataFrame, keys: Sequence[str], newest: Sequence[str] = ()) -> DataFrame:
    """One row per known key: the greatest by the `newest` columns, then by all others.

    A maximum over whole rows combines before the shuffle, so a key with very many copies sends one
    row per task, and the choice does not depend on row order. Rows with a NULL key are all kept.
    """
    return _greatest(source.filter(_known(keys)), keys, newest).unionByName(source.filter(~_known(keys)))


def keep_one_of_copies(
    source: DataFrame, keys: Sequence[str], newest: Sequence[str] = (), keyed: DataFrame | None = None
) -> DataFrame:
    """The rows of `keep_one`, moving none but those whose key comes more than once, as long as these keys are few.

    The keys alone are counted first, in `keyed` if given (the same rows with their keys). Without copies, `source` itself
    is returned, its rows where they were. Up to FEW_KEYS repeated keys are sent to every task.
    """
    spark = source.sparkSession
    path = scratch_path(spark, "repeated-keys")
    duplicate_keys(source if keyed is None else keyed, keys).write.parquet(path)
    repeated = spark.read.schema(source.select(*keys).schema).parquet(path)
    count = repeated.count()
    if not count:
        return source
    if count > FEW_KEYS:
        return keep_one(source, keys, newest)
    repeated = F.broadcast(repeated)
    copies = source.join(repeated, list(keys), "left_semi").select(*source.columns)
    others = source.join(repeated, list(keys), "left_anti").select(*source.columns)
    return _greatest(copies, keys, newest).unionByName(others)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    stand_in: Sequence[str] = (),
    keyed: DataFrame | None = None,
) -> DataFrame:
    """`target` with the rows of `source` put in: an anti join and a union.

    Rows with a NULL key match nothing; they go around the join instead of meeting in one of its
    partitions. If `stand_in` columns are named, those rows are matched by them, as far as they are known. Source keys are made distinct first, which combines the copies of a repeated key on the
    map side; AQE can split a hot key on the target's side of the join, but not on this one. They are taken from `keyed`, if
    given: rows with the keys and `stand_in` columns of `source`, each at least once.
    """
    columns = target.columns
    keyed = source if keyed is None else keyed
    arriving = keyed.filter(_known(keys)).select(*keys).distinct()
    stay = target.filter(_known(keys)).join(arriving, list(keys), "left_anti")
    unmatched = target.filter(~_known(keys))
    if stand_in:
        again = keyed.filter(~_known(keys) & _known(stand_in)).select(*stand_in).distinct()
        placed = unmatched.filter(_known(stand_in)).join(again, list(stand_in), "left_anti").select(*columns)
        unmatched = placed.unionByName(unmatched.filter(~_known(stand_in)))
    return stay.select(*columns).unionByName(unmatched).unionByName(source.select(*columns))


def resolve_duplicates(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "error",
    newest: Sequence[str] = (),
    keyed: DataFrame | None = None,
) -> DataFrame:
    """Apply the duplicate policy to the source; `keyed`, if given, are the same rows with their keys.

    `error`: several source rows for one *stored* row are an error; for a new key, all are inserted.
    `error_any`: any key twice in the source is an error.
    `keep_one`: one row per key survives.
    """
    if on_duplicate not in POLICIES:
        raise ValueError(f"unknown policy {on_duplicate!r}: expected one of {POLICIES}")
    if on_duplicate == "keep_one":
        return keep_one_of_copies(source, keys, newest, keyed)
    repeated = duplicate_keys(source if keyed is None else keyed, keys)
    if on_duplicate == "error":
        if target is None:
            return source
        repeated = repeated.join(target.filter(_known(keys)).select(*keys).distinct(), list(keys), "left_semi")
    examples = repeated.limit(5).collect()
    if examples:
        raise ValueError(f"several source rows for one key, for example {[tuple(e) for e in examples]}")
    return source


def merge_partitioned(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    partition: str,
    cluster_by: Sequence[str] = CLUSTER_COLUMNS,
    on_duplicate: str = "error",
    newest: Sequence[str] = (),
    stand_in: Sequence[str] = (),
    settled: bool = False,
) -> list | None:
    """Upsert `source` into the table at `path`, rewriting only the partitions it touches.

    Returns the touched partition values, or None if the table was created.

    Rows with a NULL key are inserted, or, if their `stand_in` columns are known, put in place of those they
    were before: a repeated merge then changes nothing.

    Exact whenever equal keys always lie in one partition, as they do here: the trip key contains the
    pickup time and the rate key the date. Untouched partitions are neither read nor written.

    `settled` says that `source` has the same rows whenever it is computed and that they lie by partition, as those of
    monthly files do. Then only its keys are kept aside, and rows of partitions that hold nothing yet are
    written where they were read.
    """
    if not path_exists(spark, path):
        first = resolve_duplicates(None, source, keys, on_duplicate, newest)
        write_clustered(first, path, partition, cluster_by)
        return None
    # The source, or all that is asked of it but its rows, is computed once: its partitions, keys and duplicates.
    staged = scratch_path(spark, "merge-source")
    asked = source.select(*dict.fromkeys([*keys, *stand_in, partition])) if settled else source
    asked.write.parquet(staged)
    keyed = spark.read.schema(asked.schema).parquet(staged)
    source = source if settled else keyed
    touched = [row[0] for row in keyed.select(partition).distinct().collect()]  # months or days
    if not touched:
        return touched
    stored = spark.read.schema(source.schema).parquet(path)
    target = stored.filter(F.col(partition).isin(touched))
    rows = resolve_duplicates(target, source, keys, on_duplicate, newest, keyed)
    held = [row[0] for row in target.select(partition).distinct().collect()] if settled else touched
    if all(value in held for value in touched):
        write_clustered(upsert(target, rows, keys, stand_in, keyed), path, partition, cluster_by)
        return touched
    fresh, as_read = rows, rows is source
    if held:
        meets = F.coalesce(F.col(partition).isin(held), F.lit(False))
        moved = upsert(target, rows.filter(meets), keys, stand_in, keyed.filter(meets))
        fresh = rows.filter(~meets)
        fresh = moved.hint("rebalance", partition).unionByName(fresh if as_read else fresh.hint("rebalance", partition))
    write_clustered(fresh, path, partition, cluster_by, rebalance=not held and not as_read)
    return touched
