"""Session settings and the shared scratch area."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

import farelake

#: Runtime settings every job relies on. All are plain SQL confs, so they can be set on a running session.
RUNTIME_CONF = {
    # Trip times carry no zone; a UTC session keeps zone-less and zoned arithmetic identical.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # AQE coalesces small shuffles, splits skewed joins and splits oversized REBALANCE partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # percentile_approx runs in an object hash aggregate, which doesn't spill while it hashes and sorts its input
    # once a task has seen so many groups (by default 128). A task over a year of days still hashes.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "512",
    # HotSpot never compiles methods over 8000 bytes of bytecode. A stage whose generated method is
    # larger runs faster operator by operator than as one interpreted method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def ship() -> None:
    """Send this package's functions to Python workers by value, so that executors needn't have it installed."""
    cloudpickle.register_pickle_by_value(farelake)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (a cluster's own session, for example)."""
    ship()
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    app: str = "farelake",
    cores: str | int = "*",
    shuffle_partitions: int = 8,
    shared_dir: str | None = None,
) -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    if shared_dir:
        builder = builder.config("spark.checkpoint.dir", shared_dir)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder path for an intermediate table.

    It lies under the shared folder the cluster names in ``spark.checkpoint.dir``, so that every
    executor can read it and it outlives any of them. Only in a local session without that setting (tests) is a
    machine-local folder made; on a cluster a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = os.path.join(tempfile.gettempdir(), "farelake-scratch")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
