"""Bronze rows to Silver rows: parse, set aside, flatten, derive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editpulse.functions import edits
from editpulse.functions.clock import Instant
from editpulse.operators.dedup import first_per_key
from editpulse.schemas import EDIT_JSON, EDIT_JSON_FEED, SILVER

SHAPES = {"struct": EDIT_JSON, "feed": EDIT_JSON_FEED}

# Anything but JSON white space.
_HAS_TEXT = r"[^ \t\r\n]"

# Arrival order of the copies of one edit.
ARRIVAL = ("ingestion_time", "offset", "partition")


def parse(bronze: DataFrame, shape: str = "struct", carry: Sequence[str] = ()) -> DataFrame:
    """The document's fields as columns, next to the carried Bronze columns.

    Texts that parse to nothing (null, blank) are dropped; broken ones stay as
    rows of nulls. The parse sits in a generator on purpose: Catalyst pushes a
    filter on a projected column below the projection and would then run the
    parse again for every such filter. Through a generator it runs once.
    """
    document = F.from_json("raw_json", SHAPES[shape])
    return bronze.filter(F.col("raw_json").rlike(_HAS_TEXT)).select(
        *carry, F.inline(F.array(document))
    )


def usable(parsed: DataFrame) -> DataFrame:
    """Documents that carry an edit id."""
    return parsed.filter(F.col("meta.id").isNotNull())


def quarantine(bronze: DataFrame, shape: str = "struct") -> DataFrame:
    """Bronze rows with text but no edit id in it: broken or foreign documents."""
    return (
        parse(bronze, shape, carry=bronze.columns)
        .filter(F.col("meta.id").isNull())
        .select(*bronze.columns)
    )


def _user_columns(shape: str) -> tuple[Column, Column]:
    if shape == "feed":
        # The feed names users but has no number for them: take a stable one.
        name = F.col("user")
        return F.when(name.isNotNull(), F.xxhash64(name)), F.col("bot")
    return F.col("user.id"), F.col("user.is_bot")


def flatten(parsed: DataFrame, shape: str = "struct", carry: Sequence[str] = ()) -> DataFrame:
    user_id, is_bot = _user_columns(shape)
    return parsed.select(
        F.col("meta.id").alias("event_id"),
        F.col("meta.dt").alias("event_time"),
        F.col("title").alias("page_title"),
        F.col("namespace"),
        F.col("type").alias("change_type"),
        user_id.alias("user_id"),
        is_bot.alias("is_bot"),
        edits.bytes_changed(F.col("length.new"), F.col("length.old")).alias("bytes_diff"),
        *carry,
    )


def classify(flat: DataFrame) -> DataFrame:
    return flat.withColumns(
        {
            "edit_size": edits.size_label(F.col("bytes_diff")),
            "user_type": edits.user_label(F.col("is_bot"), F.col("user_id")),
        }
    )


def with_delay(flat: DataFrame, now: Instant = None) -> DataFrame:
    return flat.withColumn(
        "processing_delay_seconds", edits.delay_seconds(F.col("event_time"), now)
    )


def extract(bronze: DataFrame, shape: str = "struct", carry: Sequence[str] = ARRIVAL) -> DataFrame:
    """Flat edits with an id, before dedup: the narrowest rows to shuffle."""
    return flatten(usable(parse(bronze, shape, carry)), shape, carry)


def finish(flat: DataFrame, now: Instant = None) -> DataFrame:
    """Derived columns, in the declared Silver column order."""
    return with_delay(classify(flat), now).select(*SILVER.fieldNames())


def clean(bronze: DataFrame, now: Instant = None, shape: str = "struct") -> DataFrame:
    """Batch Silver: one row per edit id, the first arrival."""
    return finish(first_per_key(extract(bronze, shape), ["event_id"], ARRIVAL), now)
