"""Silver rows to windowed KPIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editpulse.config import Settings
from editpulse.functions import kpis
from editpulse.functions.clock import since
from editpulse.schemas import GOLD, REPLAY_GOLD


def tumble(df: DataFrame, minutes: int, measures: dict[str, Column]) -> DataFrame:
    """``measures`` per epoch-aligned window; rows without a time are left out."""
    grouped = df.groupBy(F.window("event_time", f"{minutes} minutes").alias("w"))
    return grouped.agg(*kpis.named(measures)).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *measures
    )


def window_kpis(
    silver: DataFrame,
    minutes: int = Settings.kpi_minutes,
    distinct: str = "exact",
) -> DataFrame:
    """All KPIs per window, in the declared Gold column order."""
    measured = tumble(silver, minutes, kpis.edit_measures(distinct))
    return measured.withColumns(kpis.derived_metrics(minutes)).select(*GOLD.fieldNames())


def stream_kpis(silver: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Live form: late tolerance by watermark, sketched distinct counts."""
    tolerant = silver.withWatermark("event_time", settings.watermark)
    return window_kpis(tolerant, settings.kpi_minutes, "approx")


def replay_kpis(
    silver: DataFrame,
    since_time: Column | None,
    minutes: int = Settings.replay_minutes,
    date_col: str | None = None,
) -> DataFrame:
    """Reduced KPIs over all edits, or those at or after a moment, from the raw bot flag."""
    recent = silver if since_time is None else since(silver, "event_time", since_time, date_col)
    return tumble(recent, minutes, kpis.replay_measures()).select(*REPLAY_GOLD.fieldNames())


def serve(live: DataFrame, corrected: DataFrame) -> DataFrame:
    """Corrected windows in place of the live ones, live everywhere else."""
    untouched = live.join(corrected.select("window_start"), "window_start", "left_anti")
    return corrected.unionByName(untouched)
