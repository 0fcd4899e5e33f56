"""The rows that came after their window had closed, by the watermarks the engine reports.

A query beside live Gold reads the same log under the same tolerance. Of each
batch it keeps the rows that can be late: those whose window ended by the newest
event of the batches before, less the tolerance. Which of them are late
is told by the watermark that the engine worked the batch under; that stands in
the table of progress, one row for each batch.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from editpulse.config import Settings
from editpulse.sources.lake import Lake, make_folder, stored_schema
from editpulse.streaming.layers import read_log
from editpulse.streaming.progress import reports

NAME = "late_rows"


def _folder(lake: Lake) -> str:
    return f"{lake.root.rstrip('/')}/_late"


def window_end(settings: Settings) -> Column:
    return F.window("event_time", f"{settings.kpi_minutes} minutes").getField("end")


class _Newest:
    """The newest event of the batches before, as the engine reports it."""

    def __init__(self):
        self.time: datetime | None = None

    def before(self, spark: SparkSession) -> datetime | None:
        """None where nothing is known yet: right after a start."""
        last = next((q.lastProgress for q in spark.streams.active if q.name == NAME), None)
        seen = (last or {}).get("eventTime", {}).get("max")
        if seen:
            time = datetime.fromisoformat(seen.replace("Z", "+00:00"))
            self.time = time if self.time is None else max(self.time, time)
        return self.time


def keep_candidates(batch: DataFrame, number: int, lake: Lake, settings: Settings, newest: datetime | None) -> None:
    """Store what can be late of a batch, in its own folder: run again, it is written anew."""
    rows = batch.withColumn("window_end", window_end(settings)).filter(F.col("window_end").isNotNull())
    if newest is not None:
        rows = rows.filter(F.col("window_end") <= F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {settings.watermark}"))
    rows.write.mode("overwrite").parquet(f"{_folder(lake)}/batch_id={number}")


def start_late(
    spark: SparkSession, lake: Lake, settings: Settings = Settings(), trigger: dict | None = None
) -> StreamingQuery:
    """Keep the possibly late rows of ``silver_log``; its reports have to go to the table of progress."""
    make_folder(spark, _folder(lake))
    newest = _Newest()
    rows = read_log(spark, lake, "silver_log", settings).withWatermark("event_time", settings.watermark)
    writer = (
        rows.writeStream.queryName(NAME)
        .option("checkpointLocation", lake.checkpoint(NAME))
        .foreachBatch(lambda batch, n: keep_candidates(batch, n, lake, settings, newest.before(spark)))
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def late_rows(spark: SparkSession, lake: Lake) -> DataFrame:
    """Late rows with the number of their batch, their window's end and the watermark they came behind."""
    schema = stored_schema("silver_log").add("window_end", "timestamp").add("batch_id", "long")
    kept = spark.read.schema(schema).option("basePath", _folder(lake)).parquet(_folder(lake))
    marks = reports(spark, lake).filter(F.col("query") == NAME)
    marks = marks.groupBy("batch_id").agg(F.max(F.col("watermark").cast("timestamp")).alias("watermark"))
    return kept.join(marks, "batch_id").filter(F.col("window_end") <= F.col("watermark"))
