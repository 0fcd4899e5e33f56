"""What the live queries did, batch by batch, as a table; and their restart after a failure."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from editpulse.sources.lake import Lake, make_folder

ENTRY = (
    "query string, run_id string, batch_id long, started string, input_rows long, seconds double, "
    "watermark string, dropped_rows long, state_rows long, state_bytes long"
)


def entry(progress: dict) -> tuple:
    """One batch's report as a row of ``ENTRY``."""
    state = progress.get("stateOperators", [])
    total = lambda name: sum(part.get(name, 0) for part in state)
    return (
        progress.get("name"), str(progress["runId"]), progress["batchId"], progress["timestamp"], progress["numInputRows"],
        progress.get("durationMs", {}).get("triggerExecution", 0) / 1000, progress.get("eventTime", {}).get("watermark"),
        total("numRowsDroppedByWatermark"), total("numRowsTotal"), total("memoryUsedBytes"),
    )


def _path(lake: Lake) -> str:
    return f"{lake.root.rstrip('/')}/_progress"


def record(spark: SparkSession, lake: Lake, reports: list[dict]) -> None:
    """Append batch reports, at most as many as a query keeps (100 by default)."""
    if reports:
        spark.createDataFrame([entry(r) for r in reports], ENTRY).coalesce(1).write.mode("append").parquet(_path(lake))


class ProgressLog(StreamingQueryListener):
    """Appends every batch's report while a service runs; ``spark.streams.addListener`` starts it."""

    def __init__(self, spark: SparkSession, lake: Lake):
        self.spark, self.lake = spark, lake

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        record(self.spark, self.lake, [json.loads(event.progress.json)])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def reports(spark: SparkSession, lake: Lake) -> DataFrame:
    """Every finished batch once, however often it was reported."""
    make_folder(spark, _path(lake))
    return spark.read.schema(ENTRY).parquet(_path(lake)).dropDuplicates(["run_id", "batch_id", "started"])


def totals(spark: SparkSession, lake: Lake) -> DataFrame:
    """Batches with rows, rows in and rows dropped for each query, over all its runs."""
    busy = reports(spark, lake).filter("input_rows > 0")
    return busy.groupBy("query").agg(
        F.sum("input_rows").alias("input_rows"), F.sum("dropped_rows").alias("dropped_rows"),
        F.count_distinct("run_id").alias("runs"),
    )


def supervise(
    spark: SparkSession,
    lake: Lake,
    start: Callable[[], StreamingQuery],
    attempts: int = 5,
    wait: float = 1.0,
    sleep: Callable[[float], None] = time.sleep,
) -> int:
    """Run a query to its end, start it again where it fails, and record its batches.

    The wait doubles with each failure; after ``attempts`` failures in a row,
    that is without a batch that was finished in between, the last one is raised.
    Returns the number of restarts. A restart goes on from the checkpoint.
    """
    failures = restarts = 0
    while True:
        query = start()
        try:
            query.awaitTermination()
            record(spark, lake, query.recentProgress)
            return restarts
        except StreamingQueryException:
            done = [r for r in query.recentProgress if r["numInputRows"]]
            record(spark, lake, query.recentProgress)
            failures = 1 if done else failures + 1
            if failures >= attempts:
                raise
            restarts += 1
            sleep(wait * 2 ** (failures - 1))
