"""A topic has small row groups, and a replay joins its rows once."""

from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from editpulse import testbed
from editpulse.operators import upsert
from editpulse.plans import replay
from editpulse.sources import topic
from helpers import at, plan_of, rows_of, silver_df


def _groups(path):
    files = [pq.ParquetFile(f).metadata for f in Path(path).rglob("*.parquet")]
    return sum(m.num_row_groups for m in files), sum(m.num_rows for m in files)


def test_a_topic_has_row_groups_for_many_tasks(spark, lake, oracle_sf, monkeypatch):
    monkeypatch.setattr(topic, "LOG_GROUP_BYTES", 1 << 16)
    path = f"{lake.root}/topic"
    topic.publish(testbed.topic_rows(testbed.events(spark, oracle_sf)).coalesce(1), path=path)
    groups, rows = _groups(path)
    assert rows == 10_700 and groups > 3


def test_touched_windows_join_old_and_new_once(spark):
    old = silver_df(spark, [("a", at(1)), ("b", at(2)), ("c", None)])
    new = silver_df(spark, [("a", at(61)), ("b", at(2)), ("d", at(7)), ("e", None)])
    found = replay.touched_windows(new, old, [5, 10])
    assert plan_of(found).count("Join") == 1
    day = at(0).date()
    assert rows_of(found.select("minutes", F.date_format("window_start", "HH:mm"), "day")) == sorted(
        [(5, "00:00", day), (5, "01:00", day), (5, "00:05", day), (10, "00:00", day), (10, "01:00", day)], key=str
    )


def test_an_upsert_looks_for_emptied_days_among_those_without_new_rows(spark, tmp_path, monkeypatch):
    def dated(rows):
        return replay.with_day(silver_df(spark, rows), "event_time", "event_date")

    path, day, asked = str(tmp_path / "silver"), 24 * 60, []
    upsert.upsert_days(dated([("a", at(1)), ("b", at(day)), ("c", at(2 * day)), (None, at(3 * day))]), path)
    monkeypatch.setattr(upsert, "in_days", lambda col, days, same=upsert.in_days: asked.append(sorted(days)) or same(col, days))
    report = upsert.upsert_days(dated([("a", at(3)), ("b", at(2 * day + 1))]), path)
    first, second, third = (at(i * day).date() for i in range(3))
    assert asked == [[first, second, third], [second]] and report.emptied == (second,)
    left = spark.read.parquet(path).select("event_id", F.col("event_date").cast("string"))
    assert rows_of(left) == sorted(
        [("a", str(first)), ("b", str(third)), ("c", str(third)), (None, str(at(3 * day).date()))], key=str
    )
