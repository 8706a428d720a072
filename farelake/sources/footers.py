"""Parquet footers, read by the tasks of one job, however many files there are.

A footer names a file's columns, their types and its number of rows. Tasks open the files with pyarrow, several
at a time, since a footer costs a round trip and hardly any bytes. Files of a store that only Spark can open are
read through Spark, whole, which is slower but needs nothing else.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote, urlsplit

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.session import ship

#: Files a task opens at a time.
OPEN_FILES = 8
#: File names gathered in one row.
NAME_LISTS = 64

_FOUND = "num_rows bigint, columns array<struct<name: string, type: string>>"
_ARROW = [
    ("num_rows", pa.int64()),
    ("columns", pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())]))),
]
#: Spark's type names of a footer's types: plain ones, and integers by width.
_PLAIN = {"BOOLEAN": "boolean", "INT32": "int", "INT64": "bigint", "INT96": "timestamp", "FLOAT": "float", "DOUBLE": "double"}
_SIGNED = {8: "tinyint", 16: "smallint", 32: "int", 64: "bigint"}
_UNSIGNED = {8: "smallint", 16: "int", 32: "bigint", 64: "decimal(20,0)"}


def open_path(uri: str) -> tuple[fs.FileSystem, str]:
    """The pyarrow file system of a file's URI as Spark writes it, and the path there."""
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parts.path)
    scheme = {"s3a": "s3", "s3n": "s3"}.get(parts.scheme, parts.scheme)
    return fs.FileSystem.from_uri(f"{scheme}://{parts.netloc}{parts.path}")


def spark_type(column: pq.ColumnSchema) -> str:
    """The type by which Spark's Parquet reader reads a column."""
    logical = json.loads(column.logical_type.to_json())
    kind = logical.get("Type")
    if kind == "Decimal":
        return f"decimal({logical['precision']},{logical['scale']})"
    if kind == "Int":
        return (_SIGNED if logical["isSigned"] else _UNSIGNED)[logical["bitWidth"]]
    if kind == "Date":
        return "date"
    if kind == "Timestamp":
        return "timestamp" if logical["isAdjustedToUTC"] else "timestamp_ntz"
    if column.physical_type in _PLAIN:
        return _PLAIN[column.physical_type]
    return "string" if kind in ("String", "Enum", "JSON") else "binary"


def _read(source) -> tuple[int, list[dict]]:
    with pq.ParquetFile(source) as file:
        schema = file.metadata.schema
        columns = [schema.column(i) for i in range(len(schema))]
        nested = [c.path for c in columns if c.path != c.name or c.max_repetition_level]
        if nested:
            raise ValueError(f"nested columns are not supported: {nested}")
        return file.metadata.num_rows, [{"name": c.name, "type": spark_type(c)} for c in columns]


def _footer(uri: str) -> tuple[int, list[dict]]:
    system, path = open_path(uri)
    with system.open_input_file(path) as source:
        return _read(source)


def _with(batch: pa.RecordBatch, found: list[tuple[int, list[dict]]]) -> pa.RecordBatch:
    added = [pa.array([f[i] for f in found], kind) for i, (_, kind) in enumerate(_ARROW)]
    return pa.record_batch([*batch.columns, *added], [*batch.schema.names, *(name for name, _ in _ARROW)])


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with ThreadPoolExecutor(OPEN_FILES) as pool:
        for batch in batches:
            yield _with(batch, list(pool.map(_footer, batch["uri"].to_pylist())))


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_read(io.BytesIO(content)) for content in batch["content"].to_pylist()]
        yield _with(batch.drop_columns(["content"]), found)


def footers(files: DataFrame) -> DataFrame:
    """`files`, which has a column `uri`, with num_rows and columns (name and Spark type) of every file."""
    ship()
    spark = files.sparkSession
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema) + ", " + _FOUND
    first = files.first()
    if first and not _openable(first["uri"]):
        names = [row["uri"] for row in files.select("uri").collect()]
        read = spark.read.format("binaryFile").load(names).select(
            F.col("_metadata.file_path").alias("uri"), "content")
        return files.join(read, "uri").select(*files.columns, "content").mapInArrow(_contents, schema)
    # AQE would gather the few bytes of the list in one task
    return files.repartition(spark.sparkContext.defaultParallelism).mapInArrow(_footers, schema)


def _openable(uri: str) -> bool:
    try:
        open_path(uri)
        return True
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False


def distinct_schemas(files: DataFrame) -> list[tuple[list[tuple[str, str]], list[str]]]:
    """(columns, files) of each distinct schema, from one job. Only names, types and file names reach the driver."""
    found = footers(files.select("uri")).groupBy("columns", F.pmod(F.xxhash64("uri"), F.lit(NAME_LISTS)).alias("list")).agg(
        F.collect_list("uri").alias("uris")).collect()
    together: dict[tuple, list[str]] = {}
    for row in found:
        together.setdefault(tuple((c["name"], c["type"]) for c in row["columns"]), []).extend(row["uris"])
    return sorted(((list(columns), sorted(uris)) for columns, uris in together.items()), key=lambda pair: pair[1][0])


def agreeing_groups(schemas: Iterable[tuple[list[tuple[str, str]], list[str]]]) -> list[tuple[T.StructType, list[str]]]:
    """Files in groups whose columns have one type each, a handful however many files there are.

    Columns that a file lacks are no disagreement, nor is the case of a name.
    """
    groups: list[tuple[dict[str, tuple[str, str]], list[str]]] = []
    for columns, uris in schemas:
        own = {name.lower(): (name, kind) for name, kind in columns}
        for fields, names in groups:
            if all(fields[key][1] == kind for key, (_, kind) in own.items() if key in fields):
                fields.update({key: field for key, field in own.items() if key not in fields})
                names.extend(uris)
                break
        else:
            groups.append((own, list(uris)))
    return [(_struct(fields.values()), sorted(names)) for fields, names in groups]


def _struct(columns: Iterable[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StructType.fromDDL(f"c {kind}")[0].dataType) for name, kind in columns])


def file_groups(files: DataFrame) -> list[tuple[T.StructType, list[str]]]:
    return agreeing_groups(distinct_schemas(files))
