"""The report queries behind the two dashboards.

The first four read Silver, the rest read Silver or Gold as said. Ratios are
ratios of sums; distinct counts are taken from Silver because those of short
windows do not add up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editpulse import config as c
from editpulse.functions.edits import churned_bytes
from editpulse.functions.kpis import DISTINCT, percentage


def _period(time_col: str, unit: str) -> Column:
    return F.date_trunc(unit, time_col).alias("period_start")


def live_edits(
    silver: DataFrame,
    user_type: str | None = None,
    edit_size: str | None = None,
    change_type: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Newest edits first, with optional filters; ``limit`` is for a screen that shows fewer."""
    wanted = {"user_type": user_type, "edit_size": edit_size, "change_type": change_type}
    for column, value in wanted.items():
        if value is not None:
            silver = silver.filter(F.col(column) == value)
    ordered = silver.select(
        "event_time", "event_id", "page_title", "change_type", "user_id",
        "user_type", "edit_size", "bytes_diff",
    ).orderBy(F.desc("event_time"), F.desc("event_id"))
    return ordered if limit is None else ordered.limit(limit)


def velocity(silver: DataFrame, minutes: int = 1) -> DataFrame:
    """Edits per short interval."""
    per = silver.groupBy(F.window("event_time", f"{minutes} minutes").alias("w"))
    return per.agg(F.count("*").alias("edits")).select(
        F.col("w.start").alias("window_start"), "edits"
    )


def user_distribution(silver: DataFrame) -> DataFrame:
    """Edits by kind of user, whatever the kinds, and their share of all edits."""
    per_kind = silver.groupBy("user_type").agg(F.count("*").alias("edits"))
    # One row per kind of user.
    total = F.sum("edits").over(Window.partitionBy())
    return per_kind.withColumn("share_percentage", percentage(F.col("edits"), total))


def top_pages(silver: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` pages with most edits, equal counts by title."""
    return (
        silver.groupBy("page_title")
        .agg(F.count("*").alias("edits"))
        .orderBy(F.desc("edits"), "page_title")
        .limit(k)
    )


def platform_activity(silver: DataFrame, unit: str = "hour", distinct: str = "exact") -> DataFrame:
    """Edits, editors and pages per period, from Silver."""
    unique = DISTINCT[distinct]
    timed = silver.filter(F.col("event_time").isNotNull())
    return timed.groupBy(_period("event_time", unit)).agg(
        F.count("*").alias("total_edits"),
        unique("user_id").alias("unique_editors"),
        unique("page_title").alias("active_pages"),
    )


def bot_vs_human(gold: DataFrame, unit: str = "day") -> DataFrame:
    """Bot and human edits per period, counts and percentages, from Gold."""
    total, bots, humans = (F.col(n) for n in ("total_edits", "bot_edits", "human_edits"))
    summed = gold.groupBy(_period("window_start", unit)).agg(
        F.sum(total).alias("total_edits"),
        F.sum(bots).alias("bot_edits"),
        F.sum(humans).alias("human_edits"),
    )
    return summed.withColumns(
        {
            "bot_percentage": percentage(bots, total),
            "human_percentage": percentage(humans, total),
        }
    )


def edit_intensity(silver: DataFrame, unit: str = "day") -> DataFrame:
    """Byte movement per period, from Silver: every edit weighs the same."""
    diff = F.col("bytes_diff")
    timed = silver.filter(F.col("event_time").isNotNull())
    return timed.groupBy(_period("event_time", unit)).agg(
        F.avg(diff).alias("avg_bytes_per_edit"),
        F.sum(churned_bytes(diff)).alias("volatility_score"),
        F.sum(diff).alias("net_bytes_added"),
        F.count_if(churned_bytes(diff) > c.LARGE_EDIT_BYTES).alias("large_edits_count"),
    )


def knowledge_trend(gold: DataFrame, unit: str = "day") -> DataFrame:
    """Windows per growth label and period, from Gold."""
    return gold.groupBy(_period("window_start", unit), "knowledge_trend").agg(
        F.count("*").alias("windows")
    )


def engagement(silver: DataFrame, unit: str = "day", distinct: str = "exact") -> DataFrame:
    """Editors and edits per editor by kind of user, from Silver.

    Edits per editor is null where no editor is known (anonymous edits).
    """
    timed = silver.filter(F.col("event_time").isNotNull())
    per = timed.groupBy(_period("event_time", unit), "user_type").agg(
        F.count("*").alias("edits"), DISTINCT[distinct]("user_id").alias("unique_editors")
    )
    return per.withColumn("edits_per_editor", F.try_divide("edits", "unique_editors"))
