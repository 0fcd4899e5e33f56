"""One query per operator, each over the whole ``events`` table.

"Now" is always the newest event, so results do not depend on the wall clock.
Times leave as zone-less timestamps, as SQL engines without zones have them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse import testbed
from editpulse.config import TABLE_RULES, Settings, TableRule
from editpulse.functions.clock import hours, newest
from editpulse.operators import bronze, gold, late, maintenance, silver, sketches, upsert, variant
from editpulse.operators.dedup import first_per_key
from editpulse.operators.id_index import IdIndex
from editpulse.plans import dashboards, replay
from editpulse.plans.replay import latest_silver, recent_bronze, with_day
from editpulse.schemas import SILVER
from editpulse.session import STREAM_DEFAULTS, scratch_dir, shuffle_width
from editpulse.sources.feed import envelopes
from editpulse.sources.frames import read_frames
from editpulse.sources.lake import (
    LOG_GROUP_BYTES,
    Lake,
    create_tables,
    list_paths,
    move_into,
    read_layer,
    read_table,
    rename,
    set_time,
    sync_partitions,
    write_days,
)
from editpulse.sources.topic import publish, topic_stream
from editpulse.streaming import lateness, layers, progress, service

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}

# Live Gold counts these by sketch; they differ from exact counts by design.
SKETCHED = ("unique_editors", "active_pages")


def query(function: Callable[[SparkSession, DataFrame], DataFrame]) -> Callable:
    """Register ``function(spark, events)`` under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # The caller's session stays as it is; the result belongs to this one.
        own = spark.newSession()
        own.conf.set("spark.sql.session.timeZone", "UTC")
        own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
        events = testbed.events(own, sf_dir)
        for name, value in shuffle_width(events).items():
            own.conf.set(name.replace("__", "."), value)
        return zoneless(function(own, events))

    REGISTRY[function.__name__] = run
    return function


def zoneless(df: DataFrame) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.select(
        *[
            F.col(name).cast("timestamp_ntz").alias(name) if kinds[name] == "timestamp" else name
            for name in df.columns
        ]
    )


def last_event(events: DataFrame, hours_before: int = 0) -> Column:
    return newest(events, "ts", less=hours(hours_before))


def spread(events: DataFrame) -> DataFrame:
    """The events in even parts: few files of few row groups would make documents in few tasks."""
    return events.hint("rebalance")


def arrival(rows: DataFrame, unit: str) -> DataFrame:
    return rows.withColumn("batch", F.date_trunc(unit, "ingestion_time"))


def near(exact: DataFrame, sketch: DataFrame) -> DataFrame:
    """``exact`` with whether each sketched count is off by three standard errors at most.

    A count of a few is off by one at most.
    """
    sketch = sketch.select("window_start", *[F.col(name).alias(f"{name}_sketch") for name in SKETCHED])

    def flag(name: str) -> Column:
        error = F.abs(F.col(f"{name}_sketch") - F.col(name))
        return (error <= F.greatest(F.col(name) * 0.15, F.lit(1))).alias(f"{name}_near")

    both = exact.join(sketch, "window_start")
    return both.select(*exact.columns, *[flag(name) for name in SKETCHED])


# --- Sources and Bronze -----------------------------------------------------


@query
def envelope_build(spark, events):
    return envelopes(testbed.feed_lines(events))


@query
def feed_frames(spark, events):
    """Raw event-stream text through two runs of one stream; files come in between."""
    root, session = scratch_dir(spark, "frames"), _stream_session(spark)
    raw = testbed.feed_frames(events).repartition(2 * spark.sparkContext.defaultParallelism)
    raw.write.option("lineSep", "\n\n").text(f"{root}/made")
    made = sorted(path for path in list_paths(spark, f"{root}/made") if path.endswith(".txt"))
    half = len(made) // 2
    for some in (range(half), range(half, len(made))):
        for number in some:
            rename(spark, made[number], f"{root}/wire/{number:06d}")
        lines = read_frames(session, f"{root}/wire", stream=True, range_bytes=1 << 20)
        writer = lines.writeStream.option("checkpointLocation", f"{root}/checkpoint").trigger(**layers.ONCE)
        writer.format("parquet").start(f"{root}/lines").awaitTermination()
    return session.read.schema("id string, event string, data string").parquet(f"{root}/lines")


@query
def bronze_project(spark, events):
    return bronze.land(testbed.topic_rows(events), now=F.col("timestamp"))


@query
def bronze_replay_scan(spark, events):
    bound = last_event(events, Settings.lookback_hours)
    rows = recent_bronze(testbed.bronze_rows(events), bound, date_col=None)
    return rows.select("event_key", "offset", "raw_json", "ingestion_time")


# --- Silver -----------------------------------------------------------------


@query
def silver_parse(spark, events):
    parsed = silver.parse(testbed.bronze_rows(events), carry=["event_key", "offset"])
    return parsed.select(
        "event_key",
        "offset",
        F.col("meta.id").alias("meta_id"),
        F.col("meta.dt").alias("meta_dt"),
        "title",
        "namespace",
        "type",
        F.col("user.id").alias("user_id"),
        F.col("user.is_bot").alias("user_is_bot"),
        F.col("length.old").alias("length_old"),
        F.col("length.new").alias("length_new"),
    )


@query
def silver_quarantine(spark, events):
    return silver.quarantine(testbed.bronze_rows(events))


@query
def silver_flatten(spark, events):
    return silver.extract(testbed.bronze_rows(events), carry=["offset"])


@query
def silver_delay(spark, events):
    rows = silver.extract(testbed.bronze_rows(events), carry=["offset", "ingestion_time"])
    timed = silver.with_delay(rows, now=F.col("ingestion_time"))
    return timed.select("event_id", "offset", "processing_delay_seconds")


@query
def silver_classify(spark, events):
    rows = silver.classify(silver.extract(testbed.bronze_rows(events), carry=["offset"]))
    return rows.select(
        "event_id", "offset", "bytes_diff", "is_bot", "user_id", "edit_size", "user_type"
    )


@query
def silver_dedup(spark, events):
    flat = silver.extract(testbed.bronze_rows(events))
    first = first_per_key(flat, ["event_id"], silver.ARRIVAL)
    return silver.finish(first, now=F.col("ingestion_time"))


# --- Gold -------------------------------------------------------------------


@query
def gold_kpis_5m(spark, events):
    return gold.window_kpis(testbed.silver_rows(events))


@query
def bronze_to_gold(spark, events):
    """The whole batch path: documents in, KPIs out."""
    return gold.window_kpis(silver.clean(testbed.bronze_rows(events)))


@query
def gold_approx_distinct(spark, events):
    """Sketched counts of Gold's own windows against exact ones."""
    silver_rows, columns = testbed.silver_rows(events), ("window_start", "window_end", *SKETCHED)
    exact = gold.window_kpis(silver_rows).select(*columns)
    return near(exact, gold.window_kpis(silver_rows, distinct="approx"))


@query
def gold_approx_error(spark, events):
    """The same over days, where counts are large."""
    silver_rows, day = testbed.silver_rows(events), 24 * 60
    exact = gold.window_kpis(silver_rows, day).select("window_start", *SKETCHED)
    return near(exact, gold.window_kpis(silver_rows, day, distinct="approx"))


def _stored_sketches(spark, events) -> DataFrame:
    path = f"{scratch_dir(spark, 'sketches')}/windows"
    sketches.window_sketches(testbed.silver_rows(events)).write.parquet(path)
    return read_table(spark, path)


def _within(estimate: str, exact: str) -> Column:
    """Whether an estimate is off by three standard errors at most, or by one."""
    bound = F.greatest(F.col(exact) * (3 * sketches.STANDARD_ERROR), F.lit(1))
    return F.abs(F.col(estimate) - F.col(exact)) <= bound


def _rolled_up(spark, events, unit: str) -> DataFrame:
    """Periods from stored windows alone, beside exact counts from Silver."""
    rolled = sketches.roll_up(_stored_sketches(spark, events), F.date_trunc(unit, "window_start"))
    return _beside_exact(rolled, events, F.date_trunc(unit, "event_time"))


def _beside_exact(rolled: DataFrame, events: DataFrame, period: Column) -> DataFrame:
    exact = testbed.silver_rows(events).groupBy(period.alias("period_start")).agg(
        F.count_distinct("user_id").alias("exact_editors"), F.count_distinct("page_title").alias("exact_pages")
    )
    return rolled.join(exact, "period_start").select(
        "period_start", "total_edits", "exact_editors", "exact_pages",
        _within("unique_editors", "exact_editors").alias("unique_editors_near"),
        _within("active_pages", "exact_pages").alias("active_pages_near"),
    )


@query
def gold_sketches(spark, events):
    """Stored windows, each as a period of its own."""
    stored = _stored_sketches(spark, events)
    rolled = sketches.roll_up(stored, F.col("window_start"))
    return _beside_exact(rolled, events, F.window("event_time", "5 minutes").getField("start"))


@query
def dash_platform_rollup(spark, events):
    """Hours of editors and pages as unions of stored windows."""
    return _rolled_up(spark, events, "hour")


@query
def top_pages_rollup(spark, events):
    """Pages by edits over all time, from the stored windows' sketches; exact, as pages are fewer than these hold."""
    return sketches.top_pages(_stored_sketches(spark, events), k=sketches.TOP_ITEMS)


@query
def gold_replay_kpis(spark, events):
    bound = last_event(events, Settings.lookback_hours)
    return gold.replay_kpis(testbed.silver_rows(events), bound)


# --- Late data and replay ---------------------------------------------------


@query
def late_rows(spark, events):
    late_ones = late.late_rows(arrival(testbed.silver_rows(events), "hour"), "batch")
    return late_ones.select(
        "event_id", "event_time", "ingestion_time", "batch", "window_end", "watermark"
    )


def _replayed(events: DataFrame) -> DataFrame:
    """Latest state of every edit that arrived in the last day."""
    bound = last_event(events, Settings.lookback_hours)
    arrived = recent_bronze(testbed.bronze_rows(events, revisions=True), bound, date_col=None)
    return latest_silver(arrived)


def _held_before(events: DataFrame) -> DataFrame:
    """Silver as the table stood twelve hours ago."""
    rows = testbed.silver_rows(events)
    return rows.filter(F.col("ingestion_time") < last_event(events, 12)).drop(
        "ingestion_time"
    )


@query
def replay_dedup(spark, events):
    return latest_silver(testbed.bronze_rows(events, revisions=True))


@query
def upsert_matched(spark, events):
    return upsert.matched(_replayed(events), _held_before(events)).select(*SILVER.fieldNames())


@query
def upsert_inserts(spark, events):
    return upsert.inserts(_replayed(events), _held_before(events)).select(*SILVER.fieldNames())


@query
def silver_upsert(spark, events):
    return upsert.merge(_held_before(events), _replayed(events))


@query
def silver_upsert_table(spark, events):
    """The same upsert through stored, day-partitioned tables."""
    scratch = scratch_dir(spark, "upsert")
    path, staged = f"{scratch}/silver", f"{scratch}/staged"
    write_days(with_day(_held_before(events), "event_time", "event_date"), path, "event_date")
    with_day(_replayed(events), "event_time", "event_date").write.parquet(staged)
    upsert.upsert_days(read_table(spark, staged), path)
    return read_table(spark, path).select(*SILVER.fieldNames())


@query
def upsert_indexed(spark, events):
    """The same through an index of ids: it is built once, then only the buckets asked for are read."""
    scratch = scratch_dir(spark, "indexed")
    path, staged = f"{scratch}/silver", f"{scratch}/staged"
    write_days(with_day(_held_before(events), "event_time", "event_date"), path, "event_date")
    with_day(_replayed(events), "event_time", "event_date").write.parquet(staged)
    upsert.upsert_days(read_table(spark, staged), path, index=IdIndex(f"{scratch}/index"))
    return read_table(spark, path).select(*SILVER.fieldNames())


def _corrected(events: DataFrame) -> DataFrame:
    bound = last_event(events, Settings.lookback_hours)
    return replay.corrected_windows(testbed.silver_rows(events), bound)


@query
def gold_corrected(spark, events):
    return _corrected(events)


@query
def gold_replay_stored(spark, events):
    """The reduced KPIs as stored, after two replays twelve hours apart."""
    lake, rows = Lake(scratch_dir(spark, "replays")), testbed.bronze_rows(spread(events))
    half, end = last_event(events, 12), last_event(events, -1)
    parts = (rows.filter(F.col("ingestion_time") < half), half), (rows.filter(F.col("ingestion_time") >= half), end)
    for part, now in parts:
        _append_bronze(part, lake)
        replay.run_replay(spark, lake, _moment(now))
    return read_layer(spark, lake, "gold_replay").drop("window_date")


@query
def replay_after_break(spark, events):
    """Edits move to other days, the run breaks off after the upsert, and is run again."""
    lake = Lake(scratch_dir(spark, "broken"))
    _append_bronze(testbed.bronze_rows(spread(events)), lake)
    replay.run_replay(spark, lake, _moment(last_event(events, -1)))
    moved = events.filter("event_id % 25 = 0").withColumn("ts", F.col("ts") + hours(72))
    delivered = testbed.bronze_rows(moved).withColumn("ingestion_time", F.col("ingestion_time") + hours(24 * 40))
    _append_bronze(delivered, lake)
    now = _moment(last_event(events, -24 * 45))
    replay.upsert_staged(spark, lake, replay.stage(spark, lake, F.lit(now), Settings()))
    replay.run_replay(spark, lake, now)
    return read_layer(spark, lake, "gold_corrected").drop("window_date")


@query
def gold_corrected_windows(spark, events):
    """Few edits are revised and some move to other days: only the windows they touch are done again."""
    lake = Lake(scratch_dir(spark, "windows"))
    _append_bronze(testbed.bronze_rows(spread(events)), lake)
    replay.run_replay(spark, lake, _moment(last_event(events, -1)))
    moved = events.filter("event_id % 25 = 0").withColumn("ts", F.col("ts") + hours(72))
    delivered = testbed.bronze_rows(moved).withColumn("ingestion_time", F.col("ingestion_time") + hours(24 * 40))
    _append_bronze(delivered, lake)
    replay.run_replay(spark, lake, _moment(last_event(events, -24 * 45)))
    return read_layer(spark, lake, "gold_corrected").drop("window_date")


def _append_bronze(rows: DataFrame, lake: Lake) -> None:
    dated = with_day(rows, "ingestion_time", "ingestion_date")
    writer = dated.write.mode("append").option("parquet.block.size", LOG_GROUP_BYTES)
    writer.partitionBy("ingestion_date").parquet(lake.table("bronze_log"))


def _moment(now: Column):
    """A time of the data as a plain value."""
    session = SparkSession.active()
    return session.range(1).select(now.alias("now")).first()["now"]


# --- Dashboards -------------------------------------------------------------


@query
def dash_live_edits(spark, events):
    return dashboards.live_edits(
        testbed.silver_rows(events), user_type="REGISTERED", edit_size="LARGE", change_type="click"
    )


@query
def dash_velocity(spark, events):
    return dashboards.velocity(testbed.silver_rows(events))


@query
def dash_user_distribution(spark, events):
    return dashboards.user_distribution(testbed.silver_rows(events))


@query
def dash_top_pages(spark, events):
    return dashboards.top_pages(testbed.silver_rows(events))


@query
def dash_platform_activity(spark, events):
    return dashboards.platform_activity(testbed.silver_rows(events))


@query
def dash_bot_vs_human(spark, events):
    return dashboards.bot_vs_human(gold.window_kpis(testbed.silver_rows(events)))


@query
def dash_edit_intensity(spark, events):
    return dashboards.edit_intensity(testbed.silver_rows(events))


@query
def dash_knowledge_trend(spark, events):
    return dashboards.knowledge_trend(gold.window_kpis(testbed.silver_rows(events)))


@query
def dash_engagement(spark, events):
    return dashboards.engagement(testbed.silver_rows(events))


# --- Tables and maintenance -------------------------------------------------


@query
def day_partition_counts(spark, events):
    """Rows per day partition of a stored Silver table."""
    path = f"{scratch_dir(spark, 'days')}/silver"
    rows = testbed.silver_rows(events).drop("ingestion_time")
    write_days(with_day(rows, "event_time", "event_date"), path, "event_date")
    return read_table(spark, path).groupBy("event_date").agg(F.count("*").alias("edits"))


def _versions(events: DataFrame, table: Column) -> DataFrame:
    return events.select(
        table.alias("table"),
        F.col("event_id").alias("version"),
        F.col("ts").alias("committed_at"),
    )


@query
def retention_expired(spark, events):
    """Every kind of event a table of its own, all under one rule."""
    rule = TableRule(max_age_hours=2, keep_versions=5, target_file_bytes=0)
    kinds = ("click", "error", "purchase", "signup", "view")
    versions = _versions(events, F.col("event_type"))
    return maintenance.expired_versions(versions, dict.fromkeys(kinds, rule), last_event(events))


@query
def retention_rules(spark, events):
    """The three layers, each under its own rule."""
    kind = F.col("event_type")
    layer = (
        F.when(kind == "view", "bronze").when(kind == "click", "silver").otherwise("gold")
    )
    return maintenance.expired_versions(_versions(events, layer), TABLE_RULES, last_event(events))


@query
def orphan_files(spark, events):
    """Files in a stream's folder that its log does not know, by day."""
    lake, session = Lake(scratch_dir(spark, "orphans")), _stream_session(spark)
    publish(testbed.topic_rows(events), path=f"{lake.root}/topic")
    layers.start_bronze(topic_stream(session, path=f"{lake.root}/topic"), lake, layers.ONCE).awaitTermination()
    layers.start_silver(session, lake, trigger=layers.ONCE).awaitTermination()
    # What a write leaves that ends before its commit.
    path = lake.table("silver_log")
    _slotted(testbed.silver_rows(events).drop("ingestion_time"), 3).parquet(f"{lake.root}/lost")
    for day in list_paths(spark, f"{lake.root}/lost"):
        if "event_date=" in day:
            for file in list_paths(spark, day):
                move_into(spark, file, f"{path}/{day.rsplit('/', 1)[1]}")
    listing = maintenance.list_files(spark, path, "event_date")
    found = maintenance.orphan_files(listing, maintenance.committed_files(spark, path), F.current_timestamp() + hours(1))
    return found.groupBy(F.col("partition").alias("day")).agg(F.count("*").alias("orphans"))


def _slotted(rows: DataFrame, slots: int):
    """Writer of one file per day and slot of the edit's id."""
    slot = F.pmod(F.col("event_id").cast("bigint"), F.lit(slots)).cast("int")
    dated = with_day(rows, "event_time", "event_date").withColumn("_slot", slot)
    return dated.repartitionById(slots, "_slot").drop("_slot").write.partitionBy("event_date")


@query
def compaction_plan(spark, events):
    """Days of a stored table that hold many small files."""
    path = f"{scratch_dir(spark, 'plan')}/silver"
    _slotted(testbed.silver_rows(events).drop("ingestion_time"), 8).parquet(path)
    files = maintenance.list_files(spark, path, "event_date")
    plan = maintenance.compaction_plan(files, target_bytes=134217728, min_input_files=5)
    return plan.select("partition", "input_files", "small_files", "output_files")


@query
def compaction_rowcheck(spark, events):
    """A table of many small files after its rewrite: the rows are the same."""
    path = f"{scratch_dir(spark, 'compact')}/silver"
    rows = with_day(testbed.silver_rows(events).drop("ingestion_time"), "event_time", "event_date")
    scattered = rows.repartition(spark.sparkContext.defaultParallelism, "event_id")
    scattered.write.partitionBy("event_date").parquet(path)
    maintenance.compact_days(spark, path, "event_date", target_bytes=134217728, time_col="event_time")
    return read_table(spark, path).select(*SILVER.fieldNames())


@query
def compaction_by_pages(spark, events):
    """A rewrite into several files a day, along time and page: the rows are the same."""
    path = f"{scratch_dir(spark, 'curve')}/silver"
    rows = testbed.silver_rows(events).drop("ingestion_time")
    _slotted(rows, 12).parquet(path)
    size = maintenance.list_files(spark, path, "event_date").groupBy("partition").agg(F.sum("bytes").alias("n"))
    target = size.agg(F.max("n")).first()[0] // 4 + 1
    maintenance.compact_days(spark, path, "event_date", target, time_col="event_time", key_col="page_title")
    return read_table(spark, path).select(*SILVER.fieldNames())


# --- Streams, run over what is there and read back --------------------------


def _stream_session(spark: SparkSession) -> SparkSession:
    """Own settings for the streams, the caller's session stays as it is.

    The state of a stream is cut into as many parts as there are task slots.
    """
    session = spark.newSession()
    for key, value in STREAM_DEFAULTS.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return session


@query
def bronze_ingest(spark, events):
    lake = Lake(scratch_dir(spark, "bronze"))
    topic = f"{lake.root}/topic"
    publish(testbed.topic_rows(events), path=topic)
    session = _stream_session(spark)
    layers.start_bronze(topic_stream(session, path=topic), lake, layers.ONCE).awaitTermination()
    return read_layer(spark, lake, "bronze_log").drop("ingestion_time", "ingestion_date")


def _live_silver(spark, events, settings: Settings, start=layers.start_silver) -> DataFrame:
    """Silver of a log that Bronze appended in several runs, a few files at a time."""
    lake, session = Lake(scratch_dir(spark, "silver")), _stream_session(spark)
    topic, rows = f"{lake.root}/topic", testbed.topic_rows(events)
    for part in range(4):
        in_part = F.pmod(F.xxhash64("offset"), F.lit(4)) == part
        publish(rows.filter(in_part).repartition(8), path=topic)
        layers.start_bronze(topic_stream(session, path=topic), lake, layers.ONCE).awaitTermination()
    query = start(session, lake, settings, layers.ONCE)
    query.awaitTermination()
    service.require_none_dropped(query)
    return read_layer(spark, lake, "silver_log").drop("processing_delay_seconds", "event_date")


@query
def silver_stream(spark, events):
    return _live_silver(spark, events, replace(Settings(), max_files_per_trigger=5))


@query
def silver_stream_horizon(spark, events):
    """The same with ids remembered for a day of arrivals."""
    few = replace(Settings(), max_files_per_trigger=5, dedup_horizon="24 hours")
    return _live_silver(spark, events, few)


@query
def silver_stream_long(spark, events):
    """Copies come in later runs than the first, beyond a horizon of a second."""
    settings = replace(Settings(), max_files_per_trigger=8, dedup_horizon="1 second", dedup_splits=1, index_buckets=8)
    return _live_silver(spark, events, settings, layers.start_silver_long)


@query
def quarantine_stream(spark, events):
    lake, session = Lake(scratch_dir(spark, "quarantine")), _stream_session(spark)
    topic = f"{lake.root}/topic"
    publish(testbed.topic_rows(events), path=topic)
    layers.start_bronze(topic_stream(session, path=topic), lake, layers.ONCE).awaitTermination()
    layers.start_quarantine(session, lake, trigger=layers.ONCE).awaitTermination()
    return read_layer(spark, lake, "quarantine").drop("ingestion_time", "ingestion_date")


def _live_gold(spark, events, lake: Lake) -> DataFrame:
    """Live Gold of a Silver log that grows by a week of arrivals at a time.

    Every week is taken by a run of its own, as a scheduler would. A later edit
    then closes the last windows.
    """
    session = _stream_session(spark)
    rows = arrival(testbed.silver_rows(events), "week")
    # One row per week.
    weeks = sorted(row.batch for row in rows.select("batch").distinct().collect())
    steps = [rows.filter(F.col("batch") == F.lit(week)) for week in weeks]
    for step in [*steps, arrival(testbed.silver_rows(testbed.closing_event(events)), "week")]:
        stored = with_day(step.drop("ingestion_time", "batch"), "event_time", "event_date")
        stored.repartition("event_date").write.mode("append").partitionBy("event_date").parquet(lake.table("silver_log"))
        layers.start_gold(session, lake, trigger=layers.ONCE).awaitTermination()
    return read_layer(spark, lake, "gold_live").drop("window_date")


def _feed_by_day(spark, events, lake: Lake) -> None:
    """A Silver log with one file for each day of arrival, the older day the older file."""
    rows = arrival(testbed.silver_rows(events), "day").drop("ingestion_time")
    dated = with_day(rows, "event_time", "event_date").repartition("batch")
    dated.write.partitionBy("batch").parquet(f"{lake.root}/days")
    days = sorted(path for path in list_paths(spark, f"{lake.root}/days") if "batch=" in path)
    for place, day in enumerate(days):
        file = f"{lake.table('silver_log')}/part-{place:05d}.parquet"
        rename(spark, next(f for f in list_paths(spark, day) if f.endswith(".parquet")), file)
        set_time(spark, file, 1_700_000_000_000 + 60_000 * place)


@query
def late_rows_stream(spark, events):
    """The same from a stream that takes a day of arrivals at a time, by the watermarks it reports."""
    lake, session = Lake(scratch_dir(spark, "late")), _stream_session(spark)
    session.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1000")
    _feed_by_day(spark, events, lake)
    settings = replace(Settings(), max_files_per_trigger=1)
    progress.supervise(session, lake, lambda: lateness.start_late(session, lake, settings, layers.ONCE))
    return lateness.late_rows(session, lake).select("event_id", "event_time", "window_end", "watermark")


@query
def gold_stream(spark, events):
    """Live windows: what comes after its window closed is not in them."""
    live = _live_gold(spark, events, Lake(scratch_dir(spark, "gold")))
    on_time = gold.window_kpis(late.on_time_rows(arrival(testbed.silver_rows(events), "week"), "batch"))
    exact = on_time.select("window_start", *SKETCHED)
    flags = near(exact, live).drop(*SKETCHED)
    return live.drop(*SKETCHED).join(flags, "window_start")


@query
def gold_served(spark, events):
    """Corrected windows over live ones, which miss what came too late."""
    live = _live_gold(spark, events, Lake(scratch_dir(spark, "served")))
    return gold.serve(live, _corrected(events)).drop(*SKETCHED)


@query
def chain_available_now(spark, events):
    """Topic to Bronze to Silver to Gold, in two runs on the same checkpoints."""
    lake, session = Lake(scratch_dir(spark, "chain")), _stream_session(spark)
    topic = f"{lake.root}/topic"
    for step in (events, testbed.closing_event(events)):
        publish(testbed.topic_rows(step), path=topic)
        service.drain(session, lake, topic_stream(session, path=topic))
    return read_layer(spark, lake, "gold_live").drop(*SKETCHED, "window_date")


@query
def silver_feed_shape(spark, events):
    """Documents as the public feed has them: the user a name, the bot flag beside it."""
    rows = silver.clean(testbed.feed_bronze(events), now=F.col("ingestion_time"), shape="feed")
    return rows.select(
        "event_id", "event_time", "page_title", F.col("user_id").isNotNull().alias("has_user"),
        "is_bot", "bytes_diff", "edit_size", "user_type",
    )


def _mixed_bronze(events: DataFrame) -> DataFrame:
    """Documents of both shapes in one topic, some with a field that neither declares."""
    plain = testbed.bronze_rows(events).filter(F.col("offset") < testbed.REPEAT_OFFSET)
    feed = testbed.feed_bronze(events)
    rows = plain.filter("offset % 2 = 0").unionByName(feed.filter("offset % 2 = 1"))
    added = F.regexp_replace("raw_json", r"^\{", '{"wiki":"w",')
    return rows.withColumn("raw_json", F.when(F.col("offset") % 7 == 0, added).otherwise(F.col("raw_json")))


@query
def silver_variant(spark, events):
    """Both shapes by one parse; fields that no shape declares are named."""
    rows = variant.flat_edits(_mixed_bronze(events))
    return rows.select(
        "event_id", "event_time", "page_title", F.col("user_id").isNotNull().alias("has_user"),
        "is_bot", "bytes_diff", "edit_size", "user_type", F.array_join("unknown_fields", ",").alias("unknown_fields"),
        F.try_variant_get("document", "$.wiki", "string").alias("wiki"),
    )


@query
def quarantine_reasons(spark, events):
    """Feed messages that cannot be used, and why."""
    messages = testbed.feed_lines(events).filter("event = 'message'").select(F.col("data").alias("raw_json"))
    return variant.quarantined(messages)


@query
def dedup_state(spark, events):
    """The ids that the live dedup remembers after a run, read from its state."""
    lake, session = Lake(scratch_dir(spark, "state")), _stream_session(spark)
    topic = f"{lake.root}/topic"
    publish(testbed.topic_rows(events), path=topic)
    layers.start_bronze(topic_stream(session, path=topic), lake, layers.ONCE).awaitTermination()
    layers.start_silver(session, lake, replace(Settings(), dedup_splits=1), layers.ONCE).awaitTermination()
    return service.remembered_ids(session, lake)


@query
def service_progress(spark, events):
    """Rows through each layer as the batches reported them; Silver fails at first and is started again."""
    lake, session = Lake(scratch_dir(spark, "progress")), _stream_session(spark)
    topic = f"{lake.root}/topic"
    publish(testbed.topic_rows(events), path=topic)
    broken = iter([F.raise_error(F.lit("killed")).cast("timestamp")])
    starts = [
        lambda: layers.start_bronze(topic_stream(session, path=topic), lake, layers.ONCE),
        lambda: layers.start_silver(session, lake, trigger=layers.ONCE, now=next(broken, None)),
        lambda: layers.start_gold(session, lake, trigger=layers.ONCE),
    ]
    for start in starts:
        progress.supervise(session, lake, start, wait=0.1)
    return progress.totals(session, lake).select("query", "input_rows", "dropped_rows")


@query
def ddl_tables(spark, events):
    """Tables made by DDL, filled by path, told to the catalog, counted by name."""
    lake, database = Lake(scratch_dir(spark, "ddl")), f"ddl_{uuid.uuid4().hex}"
    create_tables(spark, lake, database)
    rows = with_day(testbed.silver_rows(events).drop("ingestion_time"), "event_time", "event_date")
    write_days(rows, lake.table("silver_serving"), "event_date")
    windows = with_day(gold.window_kpis(rows), "window_start", "window_date")
    write_days(windows, lake.table("gold_corrected"), "window_date")
    sync_partitions(spark, lake, database)
    counts = [
        spark.table(f"{database}.{name}")
        .groupBy(F.lit(name).alias("table_name"), F.col(day).alias("day"))
        .agg(F.count("*").alias("stored"))
        for name, day in (("silver_serving", "event_date"), ("gold_corrected", "window_date"))
    ]
    return counts[0].unionByName(counts[1])


@query
def late_correction(spark, events):
    """Live layers, then two replays: the first fills, the second adds revisions."""
    lake, session = Lake(scratch_dir(spark, "correct")), _stream_session(spark)
    topic = f"{lake.root}/topic"
    for revisions in (False, True):
        publish(testbed.topic_rows(spread(events), revisions), path=topic)
        stream = topic_stream(session, path=topic)
        layers.start_bronze(stream, lake, layers.ONCE).awaitTermination()
        replay.run_replay(session, lake)
    corrected = read_layer(spark, lake, "gold_corrected")
    return corrected.drop("window_date")
