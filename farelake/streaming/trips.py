"""Streaming variant of the load: new files in the raw lake become fact rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from farelake.plans.load import load_fact
from farelake.sources.state import new_files, read_state


def stream_trips(
    spark: SparkSession,
    bronze_root: str,
    lake: str,
    checkpoint: str,
    max_files_per_batch: int = 1000,
    on_duplicate: str = "keep_one",
) -> StreamingQuery:
    """Load every file that arrived since the last run, then stop.

    The checkpoint remembers files rather than a time, so a month that arrives late is loaded too.
    What is streamed are the files' names; each batch's files are then loaded like any others, so months whose types
    drifted load as well. A batch commits its files, the watermark and the changed months to the same state as
    the loads: neither loads again what the other has loaded, and gold and the checks learn of the months. The state
    knows files and not batches, so a batch that runs again after it was committed, or after the checkpoint was lost,
    changes nothing. One that died before is merged again; the merge knows trips by their key or else by
    their place in a file. With `on_duplicate="keep_one"`, copies of a trip are one row, in the first run as in a second
    one. `max_files_per_batch` bounds a batch, and so how much one merge has to shuffle.
    """

    def load(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        rows = batch.collect()  # at most max_files_per_batch names
        files = new_files(session, lake, session.createDataFrame(rows, batch.schema), read_state(session, lake))
        if not files.isEmpty():
            load_fact(session, bronze_root, lake, mode="by_month", files=files, on_duplicate=on_duplicate)

    return (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")  # only names are read
        .option("maxFilesPerTrigger", max_files_per_batch)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(bronze_root)
        .select(
            F.col("_metadata.file_path").alias("uri"),
            F.col("_metadata.file_size").alias("file_size"),
            F.col("_metadata.file_modification_time").alias("modified"),
        )
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
