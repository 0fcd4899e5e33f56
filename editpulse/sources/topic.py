"""The event topic: Kafka where its connector is on the classpath, else files.

Files are parquet of Kafka-shaped rows, so everything behind the source is the
same for both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.config import Settings
from editpulse.schemas import TOPIC_ROW
from editpulse.sources.lake import LOG_GROUP_BYTES


def kafka_options(servers: str, topic: str, settings: Settings = Settings()) -> dict[str, str]:
    """Options of the Kafka source; by default history before the first start is skipped.

    Messages without an id share one key and so one topic partition: long
    partitions are cut into offset ranges, each read by a task of its own.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": settings.starting_offsets,
        "failOnDataLoss": str(settings.fail_on_data_loss).lower(),
        "maxOffsetsPerTrigger": str(settings.max_offsets_per_trigger),
        "maxRecordsPerPartition": str(settings.max_records_per_task),
    }


def topic_stream(
    spark: SparkSession,
    fmt: str = "parquet",
    path: str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        return reader.load()
    return reader.schema(TOPIC_ROW).load(path)


def as_topic_rows(messages: DataFrame, topic: str) -> DataFrame:
    """Keyed messages as rows of the file form of a topic.

    A broker would number the messages. Here the moment of the write stands in
    for the number: later writes rank higher, rows of one write and partition
    rank equal, and their content decides (see ``dedup``).
    """
    return messages.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.spark_partition_id().alias("partition"),
        F.unix_micros(F.current_timestamp()).alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )


def publish(messages: DataFrame, fmt: str = "parquet", path: str | None = None, **options: str):
    """Append keyed messages to a topic; delivery is at least once."""
    writer = messages.write.format(fmt).mode("append")
    if fmt == "kafka":
        writer.options(**options).save()
    else:
        writer.option("parquet.block.size", LOG_GROUP_BYTES).options(**options).save(path)
