"""Writing and reading the stored tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.operators.fact import MONTH_COLUMN
from farelake.schemas import conform

#: Row order inside the fact's files, by both zones alike: readers of one zone, at either end, skip the row groups of others.
CLUSTER_COLUMNS = ("pickup_location_id", "dropoff_location_id")
#: Bits of an id that count for the order.
CURVE_BITS = 16
#: An append table of more files is compacted by the next append.
MOST_FILES = 100
#: Size of a compacted file.
FILE_BYTES = 128 << 20


def hadoop_path(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, location = hadoop_path(spark, path)
    return fs.exists(location)


def repair_table(spark: SparkSession, path: str) -> None:
    """Puts back a table that a dead job had moved aside, and removes what such jobs left beside it."""
    fs, target = hadoop_path(spark, path)
    if not fs.exists(target.getParent()):
        return
    beside = [s.getPath() for s in fs.listStatus(target.getParent()) if s.getPath().getName().startswith(target.getName() + "__")]
    old = sorted((p for p in beside if p.getName().startswith(target.getName() + "__old-")), key=lambda p: p.getName())
    if old and not fs.exists(target):
        fs.rename(old[-1], target)
    for leftover in beside:
        if fs.exists(leftover):
            fs.delete(leftover, True)


def replace_table(df: DataFrame, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Create or replace the table at `path`, and return it.

    The new table is written in full beside the old one and swapped in by renaming, so a table may be computed from
    its own old rows, and a job that dies while writing leaves the old table in place. Between the two renames
    there is no table; if the second fails, the old one is put back, and if the job dies there, the next call
    puts it back first. What earlier calls left beside the table is removed.
    """
    spark = df.sparkSession
    repair_table(spark, path)
    table = conform(df, schema) if schema is not None else df
    tag = uuid.uuid4().hex[:12]
    incoming, outgoing = f"{path}__next-{tag}", f"{path}__old-{tag}"
    table.write.mode("errorifexists").parquet(incoming)
    fs, target = hadoop_path(spark, path)
    _, new = hadoop_path(spark, incoming)
    _, old = hadoop_path(spark, outgoing)
    had_old = fs.exists(target)
    if had_old and not fs.rename(target, old):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(new, target):
        if had_old:
            fs.rename(old, target)
        raise OSError(f"could not move the new table to {path}")
    if had_old:
        fs.delete(old, True)
    return spark.read.parquet(path)


def append_table(df: DataFrame, path: str, schema: T.StructType | None = None, most_files: int = MOST_FILES) -> None:
    """Append rows, and compact the table when it has become many small files."""
    table = conform(df, schema) if schema is not None else df
    table.write.mode("append").parquet(path)
    if len(_data_files(df.sparkSession, path)) > most_files:
        compact_table(df.sparkSession, path, schema or table.schema)


def _data_files(spark: SparkSession, path: str) -> dict[str, int]:
    """Sizes of the table's files by name; of a table without partitions."""
    fs, folder = hadoop_path(spark, path)
    listed = [(s.getPath().getName(), s.getLen()) for s in fs.listStatus(folder) if s.isFile()]
    return {name: size for name, size in listed if not name.startswith(("_", "."))}


def compact_table(spark: SparkSession, path: str, schema: T.StructType, file_bytes: int = FILE_BYTES) -> int:
    """Rewrites the files of an append table as few as their bytes need; returns how many there are then.

    The new table is written beside the old one and swapped in by renaming, as in `replace_table`. Files that were
    appended after the rewrite had begun are copied over before the swap ends, so no row is lost or doubled; a job that dies
    leaves the old table, which the next call puts back in place.
    """
    repair_table(spark, path)
    files = _data_files(spark, path)
    count = max(1, -(-sum(files.values()) // file_bytes))
    if count >= len(files):
        return len(files)
    tag = uuid.uuid4().hex[:12]
    incoming, outgoing = f"{path}__next-{tag}", f"{path}__old-{tag}"
    fs, target = hadoop_path(spark, path)
    spark.read.schema(schema).parquet(*(f"{path}/{name}" for name in sorted(files))).coalesce(count).write.parquet(incoming)
    _, new = hadoop_path(spark, incoming)
    _, old = hadoop_path(spark, outgoing)
    if not fs.rename(target, old):
        raise OSError(f"could not move {path} aside")
    for name in _data_files(spark, outgoing).keys() - files.keys():
        _, late = hadoop_path(spark, f"{outgoing}/{name}")
        copied = spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, late, fs, new, False, spark._jsc.hadoopConfiguration())
        if not copied:
            fs.rename(old, target)
            raise OSError(f"could not copy {name}")
    if not fs.rename(new, target):
        fs.rename(old, target)
        raise OSError(f"could not move the compacted table to {path}")
    fs.delete(old, True)
    return len(_data_files(spark, path))


def replace_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def curve_place(*columns: str) -> Column:
    """Place of integers along a Z-order curve: their low `CURVE_BITS` bits interleaved. Null counts as 0."""
    def spread(column: str) -> Column:
        x = F.least(F.greatest(F.coalesce(F.col(column), F.lit(0)), F.lit(0)), F.lit((1 << CURVE_BITS) - 1)).cast("long")
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask).cast("long"))
        return x

    first, second = columns
    return F.shiftleft(spread(first), 1).bitwiseOR(spread(second))


def write_clustered(
    df: DataFrame,
    path: str,
    partition: str = MONTH_COLUMN,
    cluster_by: Sequence[str] = CLUSTER_COLUMNS,
    rebalance: bool = True,
    whole: bool = False,
) -> None:
    """Overwrite the partitions present in `df`, each file sorted by the clustering columns, or along the curve of both zones.

    With `whole`, everything that was stored is replaced; otherwise partitions without rows in `df` stay.

    `rebalance` gathers a partition's rows into evenly sized files: AQE splits a month that holds a
    large share of all rows over many tasks and merges small ones. Input that already lies by month
    (a first load from monthly files) is written where it was read, without a shuffle.
    """
    rows = df.hint("rebalance", partition) if rebalance else df
    order = (curve_place(*cluster_by),) if tuple(cluster_by) == CLUSTER_COLUMNS else cluster_by
    (
        rows.sortWithinPartitions(partition, *order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def csv_sink(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def csv_source(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read back with the known schema: dates and numbers are parsed, never guessed."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def json_records(df: DataFrame) -> DataFrame:
    """One JSON object per row, NULLs included."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("record"))
