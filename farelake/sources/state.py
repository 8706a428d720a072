"""What the loads of a lake, in batches or streamed, have committed: watermark, files and months that gold has yet to take in.

The state is a small numbered JSON file, written beside its predecessors and renamed into place after the data it
speaks of is stored. A load that dies before leaves the old state, so the next one starts from what was
committed and not from what happens to lie in the table. The loaded files are a Parquet table by load; only
loads that the state names count.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.sources.tables import hadoop_path

LEDGER = "uri string, file_size bigint, modified timestamp, load string"


@dataclass
class LoadState:
    number: int = 0
    #: Latest pickup time that a committed load has stored.
    watermark: str | None = None
    #: Ids of the committed loads.
    loads: list[str] = field(default_factory=list)
    #: A first load has begun; until one is committed, the fact may hold parts of it.
    started: bool = False
    #: Changed months (ISO dates) that gold doesn't have yet; None stands for the whole history.
    pending: list[str | None] = field(default_factory=list)
    #: Changed months whose rows haven't been checked yet, likewise.
    unchecked: list[str | None] = field(default_factory=list)

    def note_changes(self, months: list[dt.date] | None) -> None:
        """Gold and the checks have to take in `months`; the whole history, if None."""
        fresh = [None] if months is None else [month.isoformat() for month in months]
        self.pending, self.unchecked = (
            [None] if None in (*known, *fresh) else sorted({*known, *fresh}) for known in (self.pending, self.unchecked))

    def mark(self) -> dt.datetime | None:
        return dt.datetime.fromisoformat(self.watermark) if self.watermark else None


def _folder(lake: str) -> str:
    return f"{lake}/_state"


def read_state(spark: SparkSession, lake: str) -> LoadState:
    fs, folder = hadoop_path(spark, _folder(lake))
    if not fs.exists(folder):
        return LoadState()
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".json"))
    if not names:
        return LoadState()
    _, newest = hadoop_path(spark, f"{_folder(lake)}/{names[-1]}")
    stream = fs.open(newest)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return LoadState(**json.loads(text))


def write_state(spark: SparkSession, lake: str, state: LoadState) -> LoadState:
    """The next state after `state.number`; an error if another job has written one meanwhile."""
    state.number += 1
    fs, target = hadoop_path(spark, f"{_folder(lake)}/{state.number:012d}.json")
    _, incoming = hadoop_path(spark, f"{_folder(lake)}/next-{uuid.uuid4().hex}")
    stream = fs.create(incoming)
    stream.write(bytearray(json.dumps(asdict(state)).encode()))
    stream.close()
    if fs.exists(target) or not fs.rename(incoming, target):
        raise OSError(f"another load has changed the state of {lake}")
    return state


def months_of(noted: list[str | None]) -> list[dt.date] | None:
    """Noted months as dates; None for the whole history."""
    return None if None in noted else [dt.date.fromisoformat(month) for month in noted]


def new_files(spark: SparkSession, lake: str, files: DataFrame, state: LoadState) -> DataFrame:
    """Those of `files` (uri, file_size, modified) that no committed load has taken in as they are."""
    if not state.loads:
        return files
    known = spark.read.schema(LEDGER).parquet(f"{lake}/_ledger").filter(F.col("load").isin(state.loads))
    return files.join(known, ["uri", "file_size", "modified"], "left_anti")


def record_files(lake: str, files: DataFrame) -> str:
    """Notes `files` under a new load id, which counts once the state names it."""
    load = uuid.uuid4().hex
    files.select("uri", "file_size", "modified").withColumn("load", F.lit(load)).write.mode("append").partitionBy("load").parquet(
        f"{lake}/_ledger")
    return load
