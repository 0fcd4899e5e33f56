"""Retention, orphans, compaction, catalog and the job command line."""

from collections import Counter
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from editpulse import testbed
from editpulse.__main__ import main
from editpulse.config import TableRule
from editpulse.operators import maintenance as m
from editpulse.plans.replay import with_day
from editpulse.plans.upkeep import run_upkeep
from editpulse.sources.lake import (
    LAYOUT,
    create_tables,
    read_layer,
    read_table,
    register_views,
    sync_partitions,
)
from editpulse.sources.topic import publish, topic_stream
from editpulse.streaming import service
from helpers import at, rows_of


def expired(spark, rows, **keep):
    versions = spark.createDataFrame(rows, "table string, version bigint, committed_at timestamp")
    rules = {t: TableRule(max_age_hours=2, keep_versions=n, target_file_bytes=0) for t, n in keep.items()}
    found = m.expired_versions(versions, rules, at(220))
    return {(r.table, r.version) for r in found.collect()}


def test_expiry_needs_age_and_rank(spark):
    rows = [("t", i, at(i * 30)) for i in range(6)]  # 0 30 60 90 120 150, limit 100
    assert expired(spark, rows, t=1) == {("t", i) for i in range(4)}
    assert expired(spark, rows, t=4) == {("t", 0), ("t", 1)}
    assert expired(spark, rows, t=9) == set()


def test_expiry_ties_go_by_version_and_tables_have_their_own_rules(spark):
    rows = [(t, i, at(0)) for t in "tuv" for i in range(4)]
    assert expired(spark, rows, t=2, u=3) == {("t", 0), ("t", 1), ("u", 0)}


def test_plan_counts_small_files(spark):
    sizes = {"few": [10] * 4, "many": [10] * 5, "large": [90] * 9, "mixed": [10] * 5 + [100] * 3}
    files = [(day, size) for day, group in sizes.items() for size in group]
    plan = m.compaction_plan(
        spark.createDataFrame(files, "partition string, bytes bigint"), 100, 5
    )
    rows = {r.partition: (r.input_files, r.small_files, r.output_files) for r in plan.collect()}
    assert rows == {"many": (5, 5, 1), "mixed": (8, 5, 4)}


def parquet_files(path):
    return sorted(Path(path).rglob("*.parquet"))


@pytest.fixture
def scattered(spark, tmp_path, small_sf):
    path = str(tmp_path / "scattered")
    rows = testbed.silver_rows(testbed.events(spark, small_sf)).drop("ingestion_time")
    rows = rows.unionByName(rows.limit(1).withColumn("event_time", F.lit(None).cast("timestamp")))
    rows = with_day(rows, "event_time", "event_date").repartition(8, "event_id")
    rows.write.partitionBy("event_date").parquet(path)
    return path


def test_compaction_keeps_rows_and_cuts_files(spark, scattered):
    before = Counter(rows_of(read_table(spark, scattered)))
    files = Counter(f.parent.name for f in parquet_files(scattered))
    days = m.compact_days(spark, scattered, "event_date", 1 << 20, max_files_per_job=7)
    after = Counter(f.parent.name for f in parquet_files(scattered))
    assert Counter(rows_of(read_table(spark, scattered))) == before
    assert {f"event_date={day}" for day in days} == {d for d, n in files.items() if n >= 5}
    assert all(after[f"event_date={day}"] == 1 for day in days)
    # A second run finds nothing to do.
    assert m.compact_days(spark, scattered, "event_date", 1 << 20) == []


def test_compaction_splits_a_day_evenly_even_if_all_rows_are_equal(spark, tmp_path):
    path = str(tmp_path / "equal")
    day = spark.range(4000).select(
        F.lit("same").alias("v"), F.to_date(F.lit("2024-01-02")).alias("event_date")
    )
    day.repartition(20).write.partitionBy("event_date").parquet(path)
    total = sum(f.stat().st_size for f in parquet_files(path))
    m.compact_days(spark, path, "event_date", target_bytes=total // 4 + 1)
    counts = read_table(spark, path).groupBy("_metadata.file_path").count().collect()
    assert len(counts) == 4
    assert all(800 < r["count"] < 1200 for r in counts)


def test_compaction_keeps_times_together(spark, scattered):
    total = max(sum(f.stat().st_size for f in day) for day in _days(scattered))
    m.compact_days(spark, scattered, "event_date", total // 3, time_col="event_time")
    spans = (
        read_table(spark, scattered).filter("event_time IS NOT NULL")
        .groupBy("event_date", "_metadata.file_path")
        .agg(F.min("event_time").alias("low"), F.max("event_time").alias("high")).collect()
    )
    by_day = {}
    for row in spans:
        by_day.setdefault(row.event_date, []).append((row.low, row.high))
    cut = [sorted(day) for day in by_day.values() if len(day) > 1]
    assert cut and all(a[1] <= b[0] for day in cut for a, b in zip(day, day[1:]))


def _days(path):
    found = {}
    for file in parquet_files(path):
        found.setdefault(file.parent.name, []).append(file)
    return found.values()


def _groups_with(path, column, value):
    """Row groups whose statistics do not rule the value out, and all of them."""
    groups = [
        group
        for file in Path(path).rglob("*.parquet")
        for meta in [pq.ParquetFile(file).metadata]
        for group in (meta.row_group(i) for i in range(meta.num_row_groups))
    ]
    stats = [
        next(c.statistics for c in map(group.column, range(group.num_columns)) if c.path_in_schema == column)
        for group in groups
    ]
    return sum(s.min <= value <= s.max for s in stats), len(stats)


def test_compaction_along_a_curve_skips_by_page_and_by_time(spark, tmp_path):
    rows = spark.range(60_000, numPartitions=8).select(
        F.concat(F.lit("Page_"), F.xxhash64("id") % 5000).alias("page_title"),
        F.timestamp_micros(F.lit(1_704_153_600_000_000) + F.col("id") * 1_400_000).alias("event_time"),
        F.xxhash64("id", F.lit(1)).alias("noise"),
        F.lit("2024-01-02").cast("date").alias("event_date"),
    )
    rows = rows.union(spark.sql("select null, null, 1L, date'2024-01-02'"))
    shares = {}
    for name, key in (("time", None), ("curve", "page_title")):
        path = str(tmp_path / name)
        rows.repartition(40, "noise").write.partitionBy("event_date").parquet(path)
        total = sum(f.stat().st_size for f in Path(path).rglob("*.parquet"))
        days = m.compact_days(spark, path, "event_date", total // 16 + 1, 5, time_col="event_time", key_col=key)
        assert days == ["2024-01-02"]
        back = read_table(spark, path).select(*rows.columns)
        assert rows_of(back.exceptAll(rows)) == rows_of(rows.exceptAll(back)) == []
        pages, groups = _groups_with(path, "page_title", "Page_1234")
        moment = datetime(2024, 1, 2, 9, 30, tzinfo=timezone.utc)
        times, _ = _groups_with(path, "event_time", moment)
        shares[name] = (pages / groups, times / groups)
        assert groups >= 12
    assert shares["time"][0] > 0.9
    assert shares["curve"][0] < 0.5
    assert shares["curve"][1] < 0.5


def test_compaction_handles_rows_without_a_day(spark, tmp_path):
    path = str(tmp_path / "nulls")
    rows = spark.range(50).select("id", F.lit(None).cast("date").alias("event_date"))
    rows.repartition(6).write.partitionBy("event_date").parquet(path)
    m.compact_days(spark, path, "event_date", 1 << 20)
    assert len(parquet_files(path)) == 1
    assert spark.read.parquet(path).count() == 50


@pytest.fixture
def live(spark, lake, small_sf):
    topic = f"{lake.root}/topic"
    publish(testbed.topic_rows(testbed.events(spark, small_sf)), path=topic)
    service.drain(spark, lake, topic_stream(spark, path=topic))
    return lake


def test_upkeep_finds_orphans_and_deletes_only_when_told(spark, live):
    rows = read_layer(spark, live, "silver_log").count()
    known = parquet_files(live.table("silver_log"))
    orphan = known[0].with_name("left-behind.parquet")
    orphan.write_bytes(known[0].read_bytes())
    # Too young: it may belong to a running write.
    assert run_upkeep(spark, live).orphans["silver_log"] == 0
    assert run_upkeep(spark, live, datetime.now() + timedelta(hours=20)).orphans["silver_log"] == 0
    with pytest.raises(ValueError, match="running batch"):
        run_upkeep(spark, live, delete=True, orphan_hours=3)
    later = datetime.now() + timedelta(hours=25)
    assert run_upkeep(spark, live, later).orphans["silver_log"] == 1
    assert orphan.exists()
    assert run_upkeep(spark, live, later, delete=True).orphans["silver_log"] == 1
    assert parquet_files(live.table("silver_log")) == known
    assert read_layer(spark, live, "silver_log").count() == rows


def test_stream_logs_are_never_compacted(spark, live):
    with pytest.raises(ValueError, match="written by a stream"):
        m.compact_days(spark, live.table("silver_log"), "event_date", 1 << 20)


def test_tables_answer_sql_and_can_be_streamed(spark, live):
    create_tables(spark, live, "edits_db")
    create_tables(spark, live, "edits_db")
    from editpulse.plans.replay import run_replay

    run_replay(spark, live)
    sync_partitions(spark, live, "edits_db")
    for table in LAYOUT:
        by_path = read_layer(spark, live, table).count()
        assert spark.table(f"edits_db.{table}").count() == by_path, table
    assert spark.table("edits_db.silver_serving").count() == 1000
    assert spark.readStream.table("edits_db.silver_log").isStreaming
    assert "silver_log" in register_views(spark, live)
    assert spark.sql("SELECT count(*) AS n FROM silver_log").first().n == 1000


def test_command_line_jobs(spark, lake, tmp_path, small_sf, capsys):
    feed, topic = str(tmp_path / "feed"), str(tmp_path / "topic")
    testbed.feed_lines(testbed.events(spark, small_sf)).write.json(feed)
    root = ["--root", lake.root]
    main(["init", *root, "--database", "cli_db"])
    main(["publish", *root, "--feed", feed, "--topic-path", topic, "--once"])
    main(["stream", *root, "--topic-path", topic, "--once"])
    main(["replay", *root, "--database", "cli_db"])
    main(["upkeep", *root])
    assert "replayed_rows=1000" in capsys.readouterr().out
    assert spark.table("cli_db.silver_serving").count() == 1000
    assert spark.table("cli_db.silver_log").count() == 1000
