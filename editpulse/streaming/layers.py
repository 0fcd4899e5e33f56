"""The three live queries and the quarantine, each with its own checkpoint.

They hand rows on through tables only, so each can be stopped, restarted and
scaled alone. Nothing starts on import or on construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from editpulse.config import Settings
from editpulse.functions.clock import Instant
from editpulse.operators import bronze, gold, silver
from editpulse.operators.dedup import dedup_stream
from editpulse.sources.feed import envelopes
from editpulse.sources.lake import LAYOUT, Lake, stored_schema
from editpulse.sources.topic import as_topic_rows
from editpulse.streaming import long

ONCE = {"availableNow": True}


def read_log(spark: SparkSession, lake: Lake, table: str, settings: Settings) -> DataFrame:
    """A log table as a stream of its appends, oldest files first.

    Files written together come in any order among themselves. A clock on such
    a stream must not run ahead of them: a dedup horizon on the arrival time is
    safe for a log that a stream appended in order of arrival, not for one that
    was filled at once.
    """
    if lake.by_name:
        return spark.readStream.table(lake.name(table))
    return (
        spark.readStream.schema(stored_schema(table))
        .option("maxFilesPerTrigger", settings.max_files_per_trigger)
        .parquet(lake.table(table))
    )


def append_to(df: DataFrame, lake: Lake, table: str, trigger: dict | None) -> StreamingQuery:
    """Append ``df`` to a log table, partitioned by the table's day."""
    _, time_col, date_col = LAYOUT[table]
    writer = (
        df.withColumn(date_col, F.to_date(time_col))
        .writeStream.format(lake.fmt)
        .queryName(table)
        .outputMode("append")
        .option("checkpointLocation", lake.checkpoint(table))
        .partitionBy(date_col)
    )
    if not lake.by_name:
        writer = writer.option("compression", "zstd")
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.toTable(lake.name(table)) if lake.by_name else writer.start(lake.table(table))


def start_publish(
    lines: DataFrame,
    checkpoint: str,
    fmt: str = "parquet",
    path: str | None = None,
    trigger: dict | None = None,
    **options: str,
) -> StreamingQuery:
    """Feed lines to keyed messages on a topic, or into its file form."""
    messages = envelopes(lines)
    if fmt != "kafka":
        messages = as_topic_rows(messages, options.pop("topic"))
    writer = (
        messages.writeStream.format(fmt)
        .queryName("publish")
        .outputMode("append")
        .options(**options)
        .option("checkpointLocation", checkpoint)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start(path)


def start_bronze(
    topic: DataFrame, lake: Lake, trigger: dict | None = None, now: Instant = None
) -> StreamingQuery:
    """Topic to ``bronze_log``, documents unchanged."""
    return append_to(bronze.land(topic, now), lake, "bronze_log", trigger)


def silver_stream(
    bronze_log: DataFrame, settings: Settings, now: Instant = None, shape: str = "struct"
) -> DataFrame:
    """Live Silver rows; dedup sees the flat rows, before columns are added."""
    flat = silver.extract(bronze_log, shape, carry=("ingestion_time", "partition", "offset"))
    unique = dedup_stream(
        flat, "event_id", "ingestion_time", settings.dedup_horizon, settings.dedup_splits
    )
    if settings.silver_files is not None:
        unique = unique.repartition(settings.silver_files, "event_id")
    return silver.finish(unique, now)


def start_silver(
    spark: SparkSession,
    lake: Lake,
    settings: Settings = Settings(),
    trigger: dict | None = None,
    now: Instant = None,
    shape: str = "struct",
) -> StreamingQuery:
    """``bronze_log`` to ``silver_log``."""
    rows = silver_stream(read_log(spark, lake, "bronze_log", settings), settings, now, shape)
    return append_to(rows, lake, "silver_log", trigger)


def start_silver_long(
    spark: SparkSession,
    lake: Lake,
    settings: Settings = Settings(),
    trigger: dict | None = None,
    now: Instant = None,
    shape: str = "struct",
) -> StreamingQuery:
    """``bronze_log`` to ``silver_log`` with every id once for ever, and little state.

    The state holds the ids of the horizon alone and stops most copies. What
    comes through is held against an index of all ids in files, batch by batch.
    """
    if settings.dedup_horizon is None:
        raise ValueError("the state in front of the index needs a horizon")
    flat = silver.extract(
        read_log(spark, lake, "bronze_log", settings), shape, carry=("ingestion_time", "partition", "offset")
    )
    near = dedup_stream(flat, "event_id", "ingestion_time", settings.dedup_horizon, settings.dedup_splits)
    writer = (
        near.writeStream.queryName("silver_log")
        .option("checkpointLocation", lake.checkpoint("silver_log"))
        .foreachBatch(lambda batch, number: long.append_new(batch, number, lake, settings, now))
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_quarantine(
    spark: SparkSession,
    lake: Lake,
    settings: Settings = Settings(),
    trigger: dict | None = None,
    shape: str = "struct",
) -> StreamingQuery:
    """Unusable ``bronze_log`` rows to ``quarantine``."""
    log = read_log(spark, lake, "bronze_log", settings).drop("ingestion_date")
    return append_to(silver.quarantine(log, shape), lake, "quarantine", trigger)


def start_gold(
    spark: SparkSession,
    lake: Lake,
    settings: Settings = Settings(),
    trigger: dict | None = None,
) -> StreamingQuery:
    """``silver_log`` to ``gold_live``; a window is written once, when closed."""
    rows = gold.stream_kpis(read_log(spark, lake, "silver_log", settings), settings)
    return append_to(rows, lake, "gold_live", trigger)
