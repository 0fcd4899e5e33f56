"""Edit events made from the ``events`` table, for queries, tests and bench.

Every event becomes one edit document. Some are delivered twice, some lines
are broken, some arrive late, some carry unknown values; which ones follows
from the event's own columns, so SQL can restate it. No event is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.functions import edits
from editpulse.functions.clock import minutes
from editpulse.operators.silver import classify, with_delay
from editpulse.schemas import SILVER

TOPIC = "edits.raw"
REPEAT_OFFSET = 1_000_000_000
BROKEN_OFFSET = 2_000_000_000
REVISION_OFFSET = 3_000_000_000

# to_json would keep milliseconds only.
_JSON_TIME = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


# The files hold zone-less times. Read as instants (the session zone is UTC),
# so that time bounds reach the scan without a cast in between.
EVENTS = (
    "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def closing_event(source: DataFrame) -> DataFrame:
    """One event a day after the last: it closes every window before it.

    Live windows come out only once newer edits push the watermark past them.
    """
    return source.agg(
        (F.max("event_id") + 1).alias("event_id"),
        (F.max("ts") + F.expr("INTERVAL 1 DAY")).alias("ts"),
        F.lit(1).cast("bigint").alias("user_id"),
        F.lit("click").alias("event_type"),
        F.lit(0.0).alias("value"),
        F.lit('{"k": 0}').alias("props"),
    )


def _nth(step: int, rest: int) -> Column:
    return F.col("event_id") % step == rest


def edit_fields(source: DataFrame) -> DataFrame:
    """The events' columns as those of an edit."""
    return source.select(
        "event_id",
        F.col("ts").alias("event_time"),
        F.concat(F.lit("Page_"), F.get_json_object("props", "$.k")).alias("page_title"),
        (F.col("event_id") % 16).cast("int").alias("namespace"),
        F.col("event_type").alias("change_type"),
        F.when(F.col("user_id") % 5 != 0, F.col("user_id")).alias("user_id"),
        F.when(~_nth(40, 9), F.col("user_id") % 3 == 0).alias("is_bot"),
        F.when(~_nth(30, 11), F.lit(1000)).alias("old_length"),
        F.floor(F.col("value") * 20).cast("int").alias("new_length"),
        (
            F.col("ts")
            + F.when(_nth(10, 3), minutes(40)).otherwise(F.expr("INTERVAL 5 SECONDS"))
        ).alias("ingestion_time"),
    )


def document(new_length: Column) -> Column:
    """The JSON text of an edit; unknown values are left out of it."""
    return F.to_json(
        F.struct(
            F.struct(
                F.col("event_id").cast("string").alias("id"), F.col("event_time").alias("dt")
            ).alias("meta"),
            F.col("page_title").alias("title"),
            "namespace",
            F.col("change_type").alias("type"),
            F.struct(F.col("user_id").alias("id"), "is_bot").alias("user"),
            F.struct(F.col("old_length").alias("old"), new_length.alias("new")).alias("length"),
        ),
        _JSON_TIME,
    )


def _delivery(text: Column, offset: int, delay: str) -> Column:
    return F.struct(
        text.alias("raw_json"),
        (F.col("event_id") + F.lit(offset)).alias("offset"),
        (F.col("ingestion_time") + F.expr(f"INTERVAL {delay}")).alias("arrival"),
    )


def deliveries(source: DataFrame, revisions: bool = False) -> DataFrame:
    """Every delivery of every event: event_id, raw_json, offset, arrival."""
    text, broken = F.col("text"), F.lit("not json")
    revised = document(F.col("new_length") + 100)
    copies = [
        _delivery(text, 0, "0 SECONDS"),
        F.when(_nth(20, 0), _delivery(text, REPEAT_OFFSET, "1 SECOND")),
        F.when(_nth(50, 7), _delivery(broken, BROKEN_OFFSET, "0 SECONDS")),
    ]
    if revisions:
        copies.append(F.when(_nth(25, 0), _delivery(revised, REVISION_OFFSET, "1 HOUR")))
    sent = edit_fields(source).withColumn("text", document(F.col("new_length")))
    return sent.select("event_id", F.inline(F.array_compact(F.array(*copies))))


def topic_rows(source: DataFrame, revisions: bool = False) -> DataFrame:
    """The deliveries as a Kafka source would give them."""
    return deliveries(source, revisions).select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        F.col("raw_json").cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        "offset",
        F.col("arrival").alias("timestamp"),
    )


def bronze_rows(source: DataFrame, revisions: bool = False) -> DataFrame:
    """The deliveries as Bronze rows stamped with their recipe arrival."""
    return deliveries(source, revisions).select(
        F.col("event_id").cast("string").alias("event_key"),
        "raw_json",
        F.lit(TOPIC).alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        "offset",
        F.col("arrival").alias("kafka_timestamp"),
        F.col("arrival").alias("ingestion_time"),
    )


def feed_bronze(source: DataFrame) -> DataFrame:
    """The deliveries with documents as the public feed shapes them."""
    fields = edit_fields(source).withColumn("text", _feed_document())
    return fields.select(
        F.col("event_id").cast("string").alias("event_key"),
        F.col("text").alias("raw_json"),
        F.lit(TOPIC).alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ingestion_time").alias("kafka_timestamp"),
        "ingestion_time",
    )


def _feed_document() -> Column:
    """The user is a name, known users only, and the bot flag stands beside it."""
    return F.to_json(
        F.struct(
            F.struct(F.col("event_id").cast("string").alias("id"), F.col("event_time").alias("dt")).alias("meta"),
            F.col("page_title").alias("title"),
            "namespace",
            F.col("change_type").alias("type"),
            F.concat(F.lit("User "), F.col("user_id")).alias("user"),
            F.col("is_bot").alias("bot"),
            F.struct(F.col("old_length").alias("old"), F.col("new_length").alias("new")).alias("length"),
        ),
        _JSON_TIME,
    )


def feed_lines(source: DataFrame, *keep: str) -> DataFrame:
    """A captured feed: messages, a few without ids or broken, and keep-alives.

    ``keep`` names columns of the edit to keep beside them.
    """
    text = F.col("text")
    without_id = F.concat(F.lit('{"title":"'), F.col("page_title"), F.lit('"}'))
    message = F.lit("message")

    def line(event: Column, data: Column) -> Column:
        return F.struct(event.alias("event"), data.alias("data"))

    lines = [
        line(message, text),
        F.when(_nth(50, 7), line(message, F.lit("not json"))),
        F.when(_nth(50, 8), line(message, F.lit("[1]"))),
        F.when(_nth(50, 9), line(message, without_id)),
        F.when(_nth(50, 10), line(message, F.concat(F.lit('{"meta":'), text))),
        F.when(_nth(50, 11), line(F.lit("heartbeat"), text)),
    ]
    sent = edit_fields(source).withColumn("text", document(F.col("new_length")))
    return sent.select(*keep, F.inline(F.array_compact(F.array(*lines))))


def feed_frames(source: DataFrame) -> DataFrame:
    """The captured feed as raw frames: comments, messages without a name, data over several lines."""
    broken = F.when(_nth(7, 0), F.replace("data", F.lit(',"title"'), F.lit(',\n"title"'))).otherwise(F.col("data"))
    unnamed = _nth(3, 0) & (F.col("event") == "message")
    text = F.concat(
        F.when(_nth(4, 1), F.lit(": keep-alive\n")).otherwise(F.lit("")),
        F.when(unnamed, F.lit("")).otherwise(F.concat(F.lit("event: "), "event", F.lit("\n"))),
        F.concat(F.lit("id: "), "event_id", F.lit("\ndata: ")),
        F.replace(broken, F.lit("\n"), F.lit("\ndata: ")),
    )
    return feed_lines(source, "event_id").select(text.alias("value"))


def silver_rows(source: DataFrame, now: Column | None = None) -> DataFrame:
    """The clean Silver table of the events, plus each edit's arrival."""
    fields = edit_fields(source)
    flat = fields.select(
        F.col("event_id").cast("string").alias("event_id"),
        "event_time",
        "page_title",
        "namespace",
        "change_type",
        "user_id",
        "is_bot",
        edits.bytes_changed(F.col("new_length"), F.col("old_length")).alias("bytes_diff"),
        "ingestion_time",
    )
    clock = F.col("ingestion_time") if now is None else now
    return with_delay(classify(flat), clock).select(*SILVER.fieldNames(), "ingestion_time")
