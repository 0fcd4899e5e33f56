"""Per-edit expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from editpulse import config as c
from editpulse.functions.clock import Instant, instant


def bytes_changed(new: Column, old: Column) -> Column:
    """Size change; null when a side is missing or the difference overflows."""
    return F.try_subtract(new, old)


def churned_bytes(diff: Column) -> Column:
    """Absolute change, widened first: the smallest INT has no INT absolute."""
    return F.abs(diff.cast("bigint"))


def size_label(diff: Column) -> Column:
    limit = F.lit(c.LARGE_EDIT_BYTES)
    return (
        F.when(diff > limit, c.SIZE_LARGE)
        .when(diff < -limit, c.SIZE_REMOVAL)
        .otherwise(c.SIZE_SMALL)
    )


def user_label(is_bot: Column, user_id: Column) -> Column:
    """A bot flag wins over a missing id; an unknown flag says nothing."""
    return (
        F.when(is_bot, c.USER_BOT)
        .when(user_id.isNull(), c.USER_ANONYMOUS)
        .otherwise(c.USER_REGISTERED)
    )


def delay_seconds(event_time: Column, now: Instant = None) -> Column:
    """Whole seconds from the edit to ``now``, both floored to the second."""
    return F.unix_seconds(instant(now)) - F.unix_seconds(event_time)
