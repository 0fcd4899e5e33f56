"""Declared schemas; nothing is inferred from data."""

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_STRING, _INT, _LONG, _DOUBLE = StringType(), IntegerType(), LongType(), DoubleType()
_BOOL, _TIME, _BYTES = BooleanType(), TimestampType(), BinaryType()


def _record(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# One line of a server-sent-event feed.
FEED_LINE = _record(event=_STRING, data=_STRING)

# What a Kafka source delivers, and what the file form of a topic holds.
TOPIC_ROW = _record(
    key=_BYTES, value=_BYTES, topic=_STRING, partition=_INT, offset=_LONG, timestamp=_TIME
)

_META = _record(id=_STRING, dt=_TIME)
_LENGTH = _record(old=_INT, new=_INT)

# The JSON document of one edit.
EDIT_JSON = _record(
    meta=_META,
    title=_STRING,
    namespace=_INT,
    type=_STRING,
    user=_record(id=_LONG, is_bot=_BOOL),
    length=_LENGTH,
)

# The same document as the live public feed writes it: the user is a plain
# name and the bot flag sits at the top level.
EDIT_JSON_FEED = _record(
    meta=_META,
    title=_STRING,
    namespace=_INT,
    type=_STRING,
    user=_STRING,
    bot=_BOOL,
    length=_LENGTH,
)

BRONZE = _record(
    event_key=_STRING,
    raw_json=_STRING,
    topic=_STRING,
    partition=_INT,
    offset=_LONG,
    kafka_timestamp=_TIME,
    ingestion_time=_TIME,
)

SILVER = _record(
    event_id=_STRING,
    event_time=_TIME,
    page_title=_STRING,
    namespace=_INT,
    change_type=_STRING,
    user_id=_LONG,
    is_bot=_BOOL,
    bytes_diff=_INT,
    processing_delay_seconds=_LONG,
    edit_size=_STRING,
    user_type=_STRING,
)

GOLD = _record(
    window_start=_TIME,
    window_end=_TIME,
    total_edits=_LONG,
    unique_editors=_LONG,
    active_pages=_LONG,
    bot_edits=_LONG,
    human_edits=_LONG,
    net_bytes_added=_LONG,
    avg_bytes_per_edit=_DOUBLE,
    large_edits_count=_LONG,
    revert_like_edits=_LONG,
    volatility_score=_LONG,
    bot_edit_percentage=_DOUBLE,
    edits_per_minute=_DOUBLE,
    knowledge_trend=_STRING,
)

REPLAY_GOLD = _record(
    window_start=_TIME,
    window_end=_TIME,
    total_edits=_LONG,
    unique_editors=_LONG,
    bot_edits=_LONG,
    human_edits=_LONG,
    net_bytes_added=_LONG,
)
