"""Tables of other formats: by name, with the streams' and the replay's own paths."""

from datetime import date

import pytest

from editpulse import testbed
from editpulse.operators import upsert
from editpulse.plans import replay
from editpulse.plans.upkeep import run_upkeep
from editpulse.sources.lake import Lake, create_tables, read_layer
from editpulse.sources.topic import publish, topic_stream
from editpulse.streaming import layers, service


@pytest.fixture
def named(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), "orc", f"db_{tmp_path.name.replace('-', '_')}")
    create_tables(spark, lake, lake.database)
    yield lake
    spark.sql(f"DROP DATABASE {lake.database} CASCADE")


def test_a_format_without_a_database_is_refused(tmp_path):
    with pytest.raises(ValueError, match="need a database"):
        Lake(str(tmp_path), "orc")


def test_streams_write_and_read_tables_by_name(spark, named, tmp_path, small_sf):
    events = testbed.events(spark, small_sf)
    publish(testbed.topic_rows(events), path=str(tmp_path / "topic"))
    service.drain(spark, named, topic_stream(spark, path=str(tmp_path / "topic")))
    assert read_layer(spark, named, "silver_log").count() == 1000
    assert read_layer(spark, named, "quarantine").count() == 20
    detail = spark.sql(f"DESCRIBE EXTENDED {named.name('silver_log')}").collect()
    assert "orc" in {row.data_type.lower() for row in detail if row.col_name == "Provider"}


def test_replay_merges_where_the_format_takes_it(spark, named, monkeypatch, small_sf):
    """No format here takes MERGE or DELETE: what they are asked for is recorded."""
    asked = []
    monkeypatch.setattr(replay, "merge_into", lambda source, table: asked.append((table, source.count())))
    monkeypatch.setattr(replay, "write_layer", lambda df, lake, table: asked.append((table, df.count())))
    monkeypatch.setattr(replay, "drop_day", lambda spark, lake, table, day: asked.append((table, day)))
    rows = replay.with_day(testbed.bronze_rows(testbed.events(spark, small_sf)), "ingestion_time", "ingestion_date")
    columns = read_layer(spark, named, "bronze_log").columns
    rows.select(*columns).write.mode("append").insertInto(named.name("bronze_log"))
    report = replay.run_replay(spark, named)
    assert asked[0] == (named.name("silver_serving"), 1000)
    # Nothing was merged, so the touched days hold no edit and lose their windows.
    assert asked[1:3] == [("gold_corrected", 0), ("gold_replay", 0)]
    assert {day for table, day in asked[3:] if table == "gold_replay"} == set(report.days)
    assert date(2024, 1, 2) in report.days


def test_merge_is_one_statement(spark, named):
    source = read_layer(spark, named, "silver_serving")
    with pytest.raises(Exception, match="MERGE"):
        upsert.merge_into(source, named.name("silver_serving"))


def test_upkeep_is_left_to_the_format(spark, named):
    with pytest.raises(ValueError, match="own upkeep"):
        run_upkeep(spark, named)


def test_log_readers_follow_the_table(spark, named):
    assert layers.read_log(spark, named, "silver_log", layers.Settings()).isStreaming
