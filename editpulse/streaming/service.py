"""Running the live queries: as a service, or once over what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from editpulse.config import Settings
from editpulse.functions.clock import Instant
from editpulse.sources.lake import Lake, make_folder
from editpulse.streaming import layers
from editpulse.streaming.progress import ProgressLog


def _prepare(spark: SparkSession, lake: Lake) -> None:
    """Make the log folders: a stream may start before its input's first batch."""
    for table in () if lake.by_name else ("bronze_log", "silver_log"):
        make_folder(spark, lake.table(table))


def require_none_dropped(query: StreamingQuery) -> None:
    """Fail if a finished query's watermark rejected rows, for queries that must keep all."""
    dropped = sum(
        state.get("numRowsDroppedByWatermark", 0)
        for progress in query.recentProgress
        for state in progress["stateOperators"]
    )
    if dropped:
        raise RuntimeError(f"{query.name}: {dropped} rows came behind the dedup horizon")


def remembered_ids(spark: SparkSession, lake: Lake) -> DataFrame:
    """``event_id`` of all ids in the state of the live dedup (its last operator, where it has two)."""
    checkpoint = lake.checkpoint("silver_log")
    operators = spark.read.format("state-metadata").load(checkpoint)
    # One row for each operator.
    last = min(row.operatorId for row in operators.select("operatorId").distinct().collect())
    state = spark.read.format("statestore").option("operatorId", last).load(checkpoint)
    return state.select("key.event_id")


def drain(
    spark: SparkSession,
    lake: Lake,
    topic: DataFrame,
    settings: Settings = Settings(),
    now: Instant = None,
    shape: str = "struct",
) -> None:
    """Take all available input through every layer.

    Picks up where the checkpoints stand, so it can be run by a scheduler. The
    two readers of Bronze run side by side.
    """
    _prepare(spark, lake)
    layers.start_bronze(topic, lake, layers.ONCE, now).awaitTermination()
    aside = layers.start_quarantine(spark, lake, settings, layers.ONCE, shape)
    live = layers.start_silver(spark, lake, settings, layers.ONCE, now, shape)
    live.awaitTermination()
    aside.awaitTermination()
    require_none_dropped(live)
    layers.start_gold(spark, lake, settings, layers.ONCE).awaitTermination()


def serve(
    spark: SparkSession,
    lake: Lake,
    topic: DataFrame,
    settings: Settings = Settings(),
    interval: str = "10 seconds",
    shape: str = "struct",
) -> None:
    """Run all queries until one of them ends, then stop the rest.

    Any failed query ends the service with its error, so none dies unseen. Each
    batch of each query is reported to the lake's table of progress.
    """
    trigger = {"processingTime": interval}
    spark.streams.resetTerminated()  # queries of earlier runs do not count
    started: list[StreamingQuery] = []
    _prepare(spark, lake)
    log = ProgressLog(spark, lake)
    spark.streams.addListener(log)
    try:
        started.append(layers.start_bronze(topic, lake, trigger))
        started.append(layers.start_silver(spark, lake, settings, trigger, shape=shape))
        started.append(layers.start_quarantine(spark, lake, settings, trigger, shape))
        started.append(layers.start_gold(spark, lake, settings, trigger))
        spark.streams.awaitAnyTermination()
    finally:
        for query in started:
            query.stop()
        spark.streams.removeListener(log)
