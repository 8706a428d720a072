"""Copies of files, byte for byte, by the tasks of a job."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelake.session import ship
from farelake.sources.footers import open_path

CHUNK = 8 << 20
ATTEMPTS = 3
#: Subfolder of the target for copies that aren't verified yet; hidden from readers.
UNFINISHED = "_copying"


def _pumped(source, sink=None) -> tuple[int, str]:
    """Size and SHA-256 of what `source` holds, written to `sink`."""
    digest, size = hashlib.sha256(), 0
    while chunk := source.read(CHUNK):
        digest.update(chunk)
        size += len(chunk)
        if sink is not None:
            sink.write(chunk)
    return size, digest.hexdigest()


def copy_file(source: tuple[fs.FileSystem, str], folder: tuple[fs.FileSystem, str], name: str) -> tuple[int, str]:
    """Copies one file under `name` and reads the copy back; one that differs is made again.

    The copy gets its name once it is verified, so what has its name is whole, and a task that runs twice does no harm.
    """
    system, root = folder
    system.create_dir(f"{root}/{UNFINISHED}", recursive=True)
    for _ in range(ATTEMPTS):
        unfinished = f"{root}/{UNFINISHED}/{uuid.uuid4().hex}"
        with source[0].open_input_stream(source[1]) as read, system.open_output_stream(unfinished) as write:
            want = _pumped(read, write)
        with system.open_input_stream(unfinished) as read:
            have = _pumped(read)
        if have == want:
            system.move(unfinished, f"{root}/{name}")
            return want
        system.delete_file(unfinished)
    raise OSError(f"{ATTEMPTS} copies of {source[1]} differed from it")


def _copied(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    target = open_path(folder)
    for batch in batches:
        names = batch["name"].to_pylist()
        found = [copy_file(open_path(uri), target, name) for uri, name in zip(batch["uri"].to_pylist(), names)]
        yield pa.record_batch({
            "uri": batch["uri"], "name": batch["name"],
            "file_size": pa.array([size for size, _ in found], pa.int64()),
            "sha256": pa.array([digest for _, digest in found], pa.string()),
        })


def copy_files(files: DataFrame, folder: str) -> DataFrame:
    """(uri, name, file_size, sha256) of the copies of `files` (uri) made in `folder`, a URI.

    Files keep their names; of files with the same name in different folders, all but the first get a number in front.
    The copies are made when the result is consumed, a task per file: order and number of tasks don't matter.
    """
    ship()
    name, same = F.regexp_extract("uri", "[^/]+$", 0), Window.partitionBy("name").orderBy("uri")
    place = F.row_number().over(same)
    named = files.select("uri", name.alias("name")).withColumn(
        "name", F.when(place == 1, F.col("name")).otherwise(F.concat_ws("-", place.cast("string"), "name")))
    return named.repartition(max(1, min(files.count(), 10_000)), "uri").mapInArrow(
        partial(_copied, folder=folder), "uri string, name string, file_size bigint, sha256 string")
