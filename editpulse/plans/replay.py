"""Late-data correction: replay recent Bronze, upsert Silver, redo Gold."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse import session
from editpulse.config import Settings
from editpulse.functions.clock import Instant, hours, instant, newest, since
from editpulse.operators import gold, silver
from editpulse.operators.dedup import latest_per_key
from editpulse.operators.id_index import IdIndex
from editpulse.operators.upsert import in_days, merge_into, record_days, touched_days, upsert_days
from editpulse.sources.lake import (
    LOG_READ_BYTES,
    Lake,
    delete_path,
    drop_day,
    layer_exists,
    list_paths,
    path_exists,
    read_layer,
    read_table,
    write_layer,
)

_DAYS = "day date"
_WINDOWS = "minutes int, window_start timestamp, day date"


def recent_bronze(
    bronze: DataFrame, bound: Column, date_col: str | None = "ingestion_date"
) -> DataFrame:
    """Bronze rows that arrived at or after ``bound``."""
    return since(bronze, "ingestion_time", bound, date_col)


def latest_silver(bronze: DataFrame, shape: str = "struct") -> DataFrame:
    """One Silver row per edit id, the last arrival, all columns derived anew.

    The delay is measured to the arrival in Bronze, not to the replay.
    """
    flat = latest_per_key(silver.extract(bronze, shape), ["event_id"], silver.ARRIVAL)
    return silver.finish(flat, now=F.col("ingestion_time"))


def with_day(df: DataFrame, time_col: str, date_col: str) -> DataFrame:
    return df.withColumn(date_col, F.to_date(time_col))


def corrected_windows(
    silver_rows: DataFrame,
    since_time: Column,
    minutes: int = Settings.kpi_minutes,
    date_col: str | None = None,
) -> DataFrame:
    """Gold of every window that reaches past ``since_time``, each whole.

    The bound is moved back to the start of its window, so the first window is
    not computed from a part of its edits.
    """
    start = F.window(since_time, f"{minutes} minutes").getField("start")
    return gold.window_kpis(since(silver_rows, "event_time", start, date_col), minutes)


@dataclass(frozen=True)
class ReplayReport:
    days: tuple
    replayed_rows: int


def _bound(spark: SparkSession, lake: Lake, now: Column, lookback_hours: int) -> Column | None:
    """Where the replay starts: the lookback, or further back after a gap.

    None means all of Bronze: before the first finished run there is nothing
    to correct, the serving tables have to be filled.
    """
    if not path_exists(spark, lake.table("replay_log")):
        return None
    finished = spark.read.schema("replayed_to timestamp").parquet(lake.table("replay_log"))
    return F.least(now - hours(lookback_hours), newest(finished, "replayed_to"))


@dataclass(frozen=True)
class _Entry:
    """What one run keeps in the lake until it has finished."""

    path: str

    @property
    def mark(self) -> str:
        return f"{self.path}/mark"

    @property
    def rows(self) -> str:
        return f"{self.path}/rows"

    @property
    def days(self) -> str:
        return f"{self.path}/days"

    @property
    def windows(self) -> str:
        return f"{self.path}/windows"


def stage(
    spark: SparkSession, lake: Lake, clock: Column, settings: Settings, shape: str = "struct"
) -> _Entry:
    """Store the rows to replay, so that all later steps see the same ones."""
    bronze = read_layer(spark, lake, "bronze_log")
    bound = _bound(spark, lake, clock, settings.lookback_hours)
    if bound is not None:
        bronze = recent_bronze(bronze, bound)
    entry = _Entry(lake.staging(uuid.uuid4().hex))
    # Taken before the rows: what arrives in between is replayed next time.
    bronze.agg(F.max("ingestion_time").alias("replayed_to")).write.parquet(entry.mark)
    how = {"spark__sql__files__maxPartitionBytes": LOG_READ_BYTES}
    with session.settings(spark, **how, **session.shuffle_width(bronze, session.SHUFFLE_TASK_BYTES // 8)):
        latest = with_day(latest_silver(bronze, shape), "event_time", "event_date")
        latest.write.parquet(entry.rows)
    return entry


def id_index(lake: Lake, settings: Settings) -> IdIndex:
    return IdIndex(lake.index("silver_serving"), settings.index_buckets)


def touched_windows(source: DataFrame, old: DataFrame | None, widths: list[int]) -> DataFrame:
    """(minutes, window_start, day) of the windows that a changed edit is in, or was in before.

    ``old`` holds the rows that may be replaced. An edit that is the same in all
    but its delay changes no window.
    """
    columns = [name for name in source.columns if name not in ("event_id", "processing_delay_seconds")]
    new = source.select("event_id", F.col("event_time").alias("new_time"), F.struct(*columns).alias("new"))
    if old is None:
        times = new.select(F.array("new_time").alias("times"))
    else:
        before = old.select("event_id", F.col("event_time").alias("old_time"), F.struct(*columns).alias("old"))
        both = new.join(before, "event_id", "left").filter(~F.col("new").eqNullSafe(F.col("old")))
        times = both.select(F.array("new_time", "old_time").alias("times"))
    moments = times.select(F.explode("times").alias("time")).filter(F.col("time").isNotNull())
    # All widths side by side: a branch for each would join the rows again.
    for width in widths:
        moments = moments.withColumn(f"of_{width}", F.window("time", f"{width} minutes").getField("start"))
    starts = {width: F.col(f"of_{width}").alias("window_start") for width in widths}
    every = F.inline(F.array(*[F.struct(F.lit(width).alias("minutes"), start) for width, start in starts.items()]))
    return moments.drop("time").distinct().select(every).distinct().withColumn("day", F.to_date("window_start"))


def upsert_staged(spark: SparkSession, lake: Lake, entry: _Entry, settings: Settings = Settings()) -> None:
    """Bring the serving table up to date; days and windows it touches are stored first.

    A run that breaks off after this leaves them behind, and the next run takes
    them over: by then the table no longer tells where an edit was before.
    """
    source, there = read_table(spark, entry.rows), layer_exists(spark, lake, "silver_serving")
    serving, index = read_layer(spark, lake, "silver_serving") if there else None, id_index(lake, settings)
    touched = touched_days(source, serving, index=index)
    spark.createDataFrame([(day,) for day in touched], _DAYS).write.parquet(entry.days)
    old = serving.filter(in_days("event_date", touched)) if there else None
    widths = sorted({settings.kpi_minutes, settings.replay_minutes})
    touched_windows(source, old, widths).write.parquet(entry.windows)
    if lake.by_name:
        record_days(source, "event_id", "event_date", index)
        merge_into(source, lake.name("silver_serving"))
    else:
        upsert_days(source, lake.table("silver_serving"), touched=touched, index=index)


def _open_windows(spark, lake: Lake) -> list[_Entry]:
    """What runs that did not finish have left; those with windows had begun to write."""
    return [_Entry(path) for path in list_paths(spark, lake.staging(""))]


def _redo_gold(spark, lake: Lake, windows: DataFrame, settings: Settings) -> None:
    """Both Gold tables, only the touched windows of them.

    Edits outside these windows are not aggregated: of the days that have one,
    the rows are filtered by their window first. All other windows of such a day
    are taken over as they are. A window that has no edit left goes.
    """
    serving = read_layer(spark, lake, "silver_serving")
    tables = {
        "gold_corrected": (settings.kpi_minutes, lambda rows: gold.window_kpis(rows, settings.kpi_minutes)),
        "gold_replay": (settings.replay_minutes, lambda rows: gold.replay_kpis(rows, None, settings.replay_minutes)),
    }
    emptied = []
    for table, (width, measure) in tables.items():
        wanted = windows.filter(F.col("minutes") == width).select("window_start", "day").distinct()
        # One value for each day.
        days = [row.day for row in wanted.select("day").distinct().collect()]
        rows = rows_in(serving, wanted, days, width)
        redone = with_day(measure(rows), "window_start", "window_date")
        there = {row.day for row in rows.select(F.to_date("event_time").alias("day")).distinct().collect()}
        if layer_exists(spark, lake, table):
            kept = read_layer(spark, lake, table).filter(F.col("window_date").isin(days))
            kept = kept.join(wanted, "window_start", "left_anti")
            there |= {row.window_date for row in kept.select("window_date").distinct().collect()}
            redone = redone.unionByName(kept)
        write_layer(redone, lake, table)
        emptied += [(table, day) for day in sorted(set(days) - there)]
    for table, day in emptied:
        drop_day(spark, lake, table, day)


def rows_in(serving: DataFrame, windows: DataFrame, days: list, minutes: int) -> DataFrame:
    """Edits of the given windows, from their days alone; windows never cross a day."""
    start = F.window("event_time", f"{minutes} minutes").getField("start")
    rows = serving.filter(F.col("event_date").isin(days)).withColumn("window_start", start)
    return rows.join(windows.select("window_start"), "window_start", "left_semi").drop("window_start")


def run_replay(
    spark: SparkSession,
    lake: Lake,
    now: Instant = None,
    settings: Settings = Settings(),
    shape: str = "struct",
) -> ReplayReport:
    """Bring ``silver_serving``, ``gold_corrected`` and ``gold_replay`` up to date.

    The replayed rows are stored first, so that all later steps see the same
    rows however far Bronze has grown, and a lost executor costs a re-read, not
    a new parse. Repeating a run changes nothing. A run that broke off at any
    step is made good by the next: its rows are still in reach of the lookback,
    which goes back to the last finished run, and its days are stored.
    """
    left = _open_windows(spark, lake)
    entry = stage(spark, lake, instant(now), settings, shape)
    upsert_staged(spark, lake, entry, settings)
    begun = [e for e in left if path_exists(spark, f"{e.windows}/_SUCCESS")] + [entry]
    _redo_gold(spark, lake, spark.read.schema(_WINDOWS).parquet(*[e.windows for e in begun]), settings)
    # One row for each day and run.
    touched = {row.day for row in spark.read.schema(_DAYS).parquet(*[e.days for e in begun]).collect()}

    mark = spark.read.parquet(entry.mark).filter(F.col("replayed_to").isNotNull())
    mark.write.mode("append").parquet(lake.table("replay_log"))
    days = tuple(sorted(day for day in touched if day is not None))
    report = ReplayReport(days, read_table(spark, entry.rows).count())
    for done in [entry, *left]:
        delete_path(spark, done.path)
    return report


def served_gold(spark: SparkSession, lake: Lake) -> DataFrame:
    """Corrected windows over live ones; only live before the first replay."""
    live = read_layer(spark, lake, "gold_live")
    if not layer_exists(spark, lake, "gold_corrected"):
        return live
    return gold.serve(live, read_layer(spark, lake, "gold_corrected"))
