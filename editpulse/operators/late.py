"""Which rows a watermark would drop, worked out in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from editpulse.config import Settings


def batch_watermarks(rows: DataFrame, batch: str, watermark: str) -> DataFrame:
    """The watermark in force when each arrival batch starts.

    It is the newest event of all earlier batches less the tolerance. The
    table is first reduced to one row per batch; the running maximum then goes
    in two levels, within a day and over days, so that no task sees more than
    one day's batches or one row per day.
    """
    newest = rows.groupBy(batch).agg(F.max("event_time").alias("newest"))
    newest = newest.withColumn("batch_day", F.to_date(batch)).filter("batch_day IS NOT NULL")

    earlier = (Window.unboundedPreceding, -1)
    in_day = Window.partitionBy("batch_day").orderBy(batch).rowsBetween(*earlier)
    over_days = Window.orderBy("batch_day").rowsBetween(*earlier)
    days = newest.groupBy("batch_day").agg(F.max("newest").alias("day_newest"))
    days = days.select("batch_day", F.max("day_newest").over(over_days).alias("before_day"))

    seen = F.greatest(F.max("newest").over(in_day), F.col("before_day"))
    return newest.join(days, "batch_day").select(
        batch, (seen - F.expr(f"INTERVAL {watermark}")).alias("watermark")
    )


def mark_late(
    rows: DataFrame,
    batch: str,
    minutes: int = Settings.kpi_minutes,
    watermark: str = Settings.watermark,
) -> DataFrame:
    """``rows`` with their window's end, their batch's watermark and ``is_late``.

    A row is late when its window had closed before its batch arrived: the
    test is on the end of the window, not on the row's own time. Rows without
    a time have no window and are never late.
    """
    marks = batch_watermarks(rows, batch, watermark)
    window_end = F.window("event_time", f"{minutes} minutes").getField("end")
    closed = F.col("window_end") <= F.col("watermark")
    return (
        rows.withColumn("window_end", window_end)
        .join(marks, batch, "left")
        .withColumn("is_late", F.coalesce(closed, F.lit(False)))
    )


def late_rows(rows: DataFrame, batch: str, **limits) -> DataFrame:
    return mark_late(rows, batch, **limits).filter("is_late").drop("is_late")


def on_time_rows(rows: DataFrame, batch: str, **limits) -> DataFrame:
    """What the live windows are computed from."""
    kept = mark_late(rows, batch, **limits).filter(~F.col("is_late"))
    return kept.select(*rows.columns)
