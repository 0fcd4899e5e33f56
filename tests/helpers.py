"""Hand-made rows for the tests."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.operators.silver import classify, with_delay
from editpulse.schemas import BRONZE, SILVER

DAY = datetime(2024, 1, 2)


def at(minutes: float, day: datetime = DAY) -> datetime:
    return day + timedelta(minutes=minutes)


def bronze_df(spark: SparkSession, texts, arrival: datetime = DAY) -> DataFrame:
    rows = [
        (f"k{i}", text, "t", 0, i, arrival, arrival + timedelta(seconds=i))
        for i, text in enumerate(texts)
    ]
    return spark.createDataFrame(rows, BRONZE)


def silver_df(spark: SparkSession, rows) -> DataFrame:
    """Rows of (event_id, event_time) plus optional user_id, is_bot, bytes_diff, page."""
    defaults = {"user_id": 1, "is_bot": False, "bytes_diff": 0, "page_title": "P"}
    full = []
    for event_id, event_time, *extra in rows:
        values = {**defaults, **(extra[0] if extra else {})}
        full.append((event_id, event_time, *values.values()))
    flat = spark.createDataFrame(
        full,
        "event_id string, event_time timestamp, user_id bigint, is_bot boolean, "
        "bytes_diff int, page_title string",
    ).select("*", F.lit(0).alias("namespace"), F.lit("edit").alias("change_type"))
    return with_delay(classify(flat), F.col("event_time")).select(*SILVER.fieldNames())


def rows_of(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
