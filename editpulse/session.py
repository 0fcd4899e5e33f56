"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Estimated bytes per shuffle task.
SHUFFLE_TASK_BYTES = 128 << 20
_MOST_TASKS = (1 << 31) - 1

# What a stream's session needs; safe to set on a running session.
STREAM_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    # The usual form of times in parquet has no statistics: nothing is skipped.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Dedup and window state outgrow the heap: keep it in RocksDB, ship deltas.
    "spark.sql.streaming.stateStore.providerClass": _ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # One memory limit for all state parts of an executor, not one for each.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # Counting rows would cost a read before every write.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}

DEFAULTS = {
    **STREAM_DEFAULTS,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "editpulse", **overrides: str) -> SparkSession:
    """Session with the job defaults; master and sizes come from spark-submit.

    ``spark.sql.shuffle.partitions`` is left to the submitter: batch jobs let
    adaptive execution coalesce, while a stream fixes the number in its
    checkpoint on first start, so it must be chosen for the cluster.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for one block; names with ``__`` for each dot."""
    named = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in named}
    try:
        for name, value in named.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shuffle_width(df: DataFrame, task_bytes: int = SHUFFLE_TASK_BYTES) -> dict[str, str]:
    """Setting for enough shuffle tasks for the data behind ``df``.

    A fixed number is too small for a big table and is the start of spilling.
    The size is Spark's own estimate from the files the plan reads; where it
    comes out too wide, adaptive execution merges the tasks again.
    """
    spark = df.sparkSession
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = math.ceil(estimate / task_bytes)
    # Spark's mark for an unknown size is one that no lake has.
    tasks = usual if tasks > _MOST_TASKS else max(usual, tasks)
    return {"spark__sql__adaptive__coalescePartitions__initialPartitionNum": str(tasks)}


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for intermediate tables that every executor can reach.

    Uses the folder the cluster names in ``spark.checkpoint.dir``. Only where
    that is unset on one machine (tests) a local temporary folder is made.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if shared:
        return f"{shared.rstrip('/')}/editpulse-{purpose}-{uuid.uuid4().hex}"
    return tempfile.mkdtemp(prefix=f"editpulse-{purpose}-")
