"""Topic rows to Bronze rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.functions.clock import Instant, instant


def land(topic_rows: DataFrame, now: Instant = None) -> DataFrame:
    """Text key and value, provenance columns and the arrival stamp.

    A cast and not ``decode``, which stops the job at the first bad byte.
    """
    return topic_rows.select(
        F.col("key").cast("string").alias("event_key"),
        F.col("value").cast("string").alias("raw_json"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        instant(now).alias("ingestion_time"),
    )
