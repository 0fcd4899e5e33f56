"""Documents of drifting shape: one parse to VARIANT, nothing lost, and a reason for what is set aside."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editpulse.functions import edits
from editpulse.operators.silver import _HAS_TEXT, classify
from editpulse.schemas import EDIT_JSON, EDIT_JSON_FEED

NOT_JSON, NOT_OBJECT, NO_ID = "not json", "not an object", "no id"
KNOWN = sorted(set(EDIT_JSON.fieldNames()) | set(EDIT_JSON_FEED.fieldNames()))


def documents(bronze: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The carried columns and ``document``, parsed once (in a generator, see ``silver.parse``); null where broken."""
    parsed = F.explode(F.array(F.try_parse_json("raw_json"))).alias("document")
    return bronze.filter(F.col("raw_json").rlike(_HAS_TEXT)).select(*carry, parsed)


def _get(path: str, kind: str) -> Column:
    return F.try_variant_get("document", path, kind)


def _is_object(variant: Column) -> Column:
    return F.schema_of_variant(variant).startswith("OBJECT")


def reason() -> Column:
    """Why a document cannot be used, null if it can."""
    return (
        F.when(F.col("document").isNull(), NOT_JSON)
        .when(~_is_object(F.col("document")), NOT_OBJECT)
        .when(_get("$.meta.id", "string").isNull(), NO_ID)
    )


def quarantined(bronze: DataFrame) -> DataFrame:
    """Bronze rows that cannot be used, with the reason."""
    rows = documents(bronze, carry=bronze.columns).withColumn("reason", reason())
    return rows.filter(F.col("reason").isNotNull()).select(*bronze.columns, "reason")


def flat_edits(bronze: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Flat classified edits from documents of either shape, mixed as they come.

    The user is an object with a number and a flag, or a name beside a flag; a
    field of another type than expected is null. ``unknown_fields`` names the
    fields that no shape declares, and ``document`` keeps them all.
    """
    rows = documents(bronze, carry=[*carry, "raw_json"]).filter(reason().isNull())
    user = F.try_variant_get("document", "$.user", "variant")
    name = F.when(F.schema_of_variant(user) == "STRING", _get("$.user", "string"))
    flat = rows.select(
        _get("$.meta.id", "string").alias("event_id"),
        _get("$.meta.dt", "timestamp").alias("event_time"),
        _get("$.title", "string").alias("page_title"),
        _get("$.namespace", "int").alias("namespace"),
        _get("$.type", "string").alias("change_type"),
        F.coalesce(_get("$.user.id", "bigint"), F.when(name.isNotNull(), F.xxhash64(name))).alias("user_id"),
        F.coalesce(_get("$.user.is_bot", "boolean"), _get("$.bot", "boolean")).alias("is_bot"),
        edits.bytes_changed(_get("$.length.new", "int"), _get("$.length.old", "int")).alias("bytes_diff"),
        F.array_sort(F.array_except(F.json_object_keys("raw_json"), F.array(*map(F.lit, KNOWN)))).alias("unknown_fields"),
        "document",
        *carry,
    )
    return classify(flat)
