"""Server-sent-event lines to keyed messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.config import UNKNOWN_KEY
from editpulse.schemas import FEED_LINE

# Only the id is wanted; the extra column receives what is not one JSON object.
_ID_ONLY = "meta struct<id: string>, unreadable string"
_STRICT = {"columnNameOfCorruptRecord": "unreadable", "allowSingleQuotes": "false"}
_WHITE = " \t\r\n"


def read_feed(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Captured feed lines as JSON records of event name and data text."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(FEED_LINE).json(path)


def envelopes(lines: DataFrame) -> DataFrame:
    """Messages keyed by the edit id; the document itself is passed unchanged.

    Texts that are not one whole JSON object are skipped. One parse both checks
    the document and finds its id; as in Silver it sits in a generator, so that
    the filter behind it does not repeat it. The parser stops at the closing
    brace: that nothing follows it is checked on the text.
    """
    messages = lines.filter(F.col("event") == "message")
    whole = messages.filter(F.rtrim("data", F.lit(_WHITE)).endswith("}"))
    read = F.from_json("data", _ID_ONLY, _STRICT)
    return (
        whole.select("data", F.inline(F.array(read)))
        .filter(F.col("unreadable").isNull())
        .select(
            F.coalesce(F.col("meta.id"), F.lit(UNKNOWN_KEY)).alias("key"),
            F.col("data").alias("value"),
        )
    )
