"""KPI measures of a group of edits, and metrics derived from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from editpulse import config as c
from editpulse.functions.edits import churned_bytes

# How distinct users and pages are counted. Streams accept only "approx".
DISTINCT = {"exact": F.count_distinct, "approx": F.approx_count_distinct}


def edit_measures(distinct: str) -> dict[str, Column]:
    """Aggregates over Silver rows; every one has a map-side partial form."""
    unique = DISTINCT[distinct]
    diff = F.col("bytes_diff")
    by_bot = F.col("user_type") == c.USER_BOT
    return {
        "total_edits": F.count("*"),
        "unique_editors": unique("user_id"),
        "active_pages": unique("page_title"),
        "bot_edits": F.count_if(by_bot),
        "human_edits": F.count_if(~by_bot),
        "net_bytes_added": F.sum(diff),
        "avg_bytes_per_edit": F.avg(diff),
        "large_edits_count": F.count_if(churned_bytes(diff) > c.LARGE_EDIT_BYTES),
        "revert_like_edits": F.count_if(diff < -c.LARGE_EDIT_BYTES),
        "volatility_score": F.sum(churned_bytes(diff)),
    }


def replay_measures() -> dict[str, Column]:
    """The reduced set of the replay; an unknown bot flag counts on no side."""
    flag = F.col("is_bot")
    return {
        "total_edits": F.count("*"),
        "unique_editors": F.count_distinct("user_id"),
        "bot_edits": F.count_if(flag),
        "human_edits": F.count_if(~flag),
        "net_bytes_added": F.sum("bytes_diff"),
    }


def percentage(part: Column, whole: Column) -> Column:
    return part / whole * 100


def trend_label(net_bytes: Column) -> Column:
    """Unknown growth is neither up nor down."""
    return (
        F.when(net_bytes > 0, c.TREND_UP)
        .when(net_bytes < 0, c.TREND_DOWN)
        .otherwise(c.TREND_FLAT)
    )


def derived_metrics(window_minutes: int) -> dict[str, Column]:
    """Metrics computed from the measures of one window."""
    total = F.col("total_edits")
    return {
        "bot_edit_percentage": percentage(F.col("bot_edits"), total),
        "edits_per_minute": total / F.lit(float(window_minutes)),
        "knowledge_trend": trend_label(F.col("net_bytes_added")),
    }


def named(measures: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in measures.items()]
