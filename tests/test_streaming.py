"""Live queries: watermark, lateness, dedup, restart, and agreement with batch."""

import time
from dataclasses import replace
from datetime import timedelta
from pathlib import Path
from threading import Thread

import pytest
from pyspark.sql import functions as F

from editpulse import testbed
from editpulse.config import Settings
from editpulse.operators import gold, silver
from editpulse.plans.replay import with_day
from editpulse.schemas import GOLD, SILVER
from editpulse.sources.lake import path_exists, read_layer
from editpulse.sources.topic import kafka_options, publish, topic_stream
from editpulse.streaming import layers, service
from helpers import at, rows_of, silver_df

SMALL = replace(Settings(), dedup_splits=2)


def feed_silver(spark, lake, times):
    rows = silver_df(spark, [(f"e{t}", None if t is None else at(t)) for t in times])
    stored = with_day(rows, "event_time", "event_date")
    stored.write.mode("append").partitionBy("event_date").parquet(lake.table("silver_log"))


def run_gold(spark, lake):
    query = layers.start_gold(spark, lake, trigger=layers.ONCE)
    query.awaitTermination()
    return sum(
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for operator in progress.stateOperators
    )


def windows(spark, lake):
    rows = read_layer(spark, lake, "gold_live").collect()
    return {(r.window_start - at(0)) // timedelta(minutes=1): r.total_edits for r in rows}


def test_windows_come_out_once_when_closed(spark, lake):
    steps = [
        ([1, 4, 7], {}, 0),
        ([20, None], {0: 2, 5: 1}, 0),
        ([2, 13], {0: 2, 5: 1}, 1),
        ([40], {0: 2, 5: 1, 10: 1, 20: 1}, 0),
    ]
    for times, closed, dropped in steps:
        feed_silver(spark, lake, times)
        assert run_gold(spark, lake) == dropped
        assert windows(spark, lake) == closed


def test_lateness_is_judged_by_the_end_of_the_window(spark, lake):
    feed_silver(spark, lake, [18])
    assert run_gold(spark, lake) == 0
    feed_silver(spark, lake, [6, 4])
    assert run_gold(spark, lake) == 1
    feed_silver(spark, lake, [40])
    run_gold(spark, lake)
    assert windows(spark, lake) == {5: 1, 15: 1}


def test_batch_twin_names_the_rows_the_stream_drops(spark, lake):
    """Arrival batches one minute apart, as the stream would take them."""
    from editpulse.operators.late import late_rows

    steps = [[1, 4, 7], [20], [2, 13], [40, 3], [29, 31, 8], [60]]
    dropped = 0
    for times in steps:
        feed_silver(spark, lake, times)
        dropped += run_gold(spark, lake)
    rows = [(f"e{t}", at(t), i) for i, times in enumerate(steps) for t in times]
    arrived = spark.createDataFrame(rows, "event_id string, event_time timestamp, step int")
    arrived = arrived.withColumn("batch", F.lit(at(0)) + F.make_dt_interval(mins="step"))
    named = {r.event_id for r in late_rows(arrived, "batch").collect()}
    assert named == {"e2", "e3", "e8", "e29"}
    # The stream counts partial groups, here one row each.
    assert dropped == len(named)


def put_bronze(spark, lake, copies, arrival):
    texts = [(f'{{"meta":{{"id":"{i}"}},"title":"{t}"}}', n) for n, (i, t) in enumerate(copies)]
    rows = spark.createDataFrame(texts, "raw_json string, offset bigint").select(
        F.lit("k").alias("event_key"), "raw_json", F.lit("t").alias("topic"),
        F.lit(0).alias("partition"), "offset", F.lit(arrival).alias("kafka_timestamp"),
        F.lit(arrival).alias("ingestion_time"),
    )
    stored = with_day(rows, "ingestion_time", "ingestion_date")
    stored.write.mode("append").partitionBy("ingestion_date").parquet(lake.table("bronze_log"))


def run_silver(spark, lake, settings):
    layers.start_silver(spark, lake, settings, layers.ONCE).awaitTermination()
    return sorted(r.event_id for r in read_layer(spark, lake, "silver_log").collect())


@pytest.mark.parametrize("splits", [1, 4])
def test_dedup_remembers_ids_for_the_horizon(spark, lake, splits):
    settings = replace(Settings(), dedup_horizon="24 hours", dedup_splits=splits)
    put_bronze(spark, lake, [("a", "1")] * 50 + [("b", "1")], at(0))
    assert run_silver(spark, lake, settings) == ["a", "b"]
    put_bronze(spark, lake, [("a", "2"), ("c", "1")], at(60 * 23))
    assert run_silver(spark, lake, settings) == ["a", "b", "c"]
    # Two days on the watermark passes the first day, its ids are forgotten.
    put_bronze(spark, lake, [("d", "1")], at(60 * 72))
    run_silver(spark, lake, settings)
    put_bronze(spark, lake, [("a", "3"), ("d", "2")], at(60 * 73))
    assert run_silver(spark, lake, settings) == ["a", "a", "b", "c", "d"]


def test_dedup_without_horizon_never_forgets(spark, lake):
    settings = replace(Settings(), dedup_horizon=None, dedup_splits=2)
    for day in range(4):
        put_bronze(spark, lake, [("a", str(day))], at(60 * 24 * day))
        assert run_silver(spark, lake, settings) == ["a"]


def test_late_edits_and_edits_without_time_stay_in_silver(spark, lake):
    put_bronze(spark, lake, [("a", "1")], at(0))
    text = '{"meta":{"id":"old","dt":"2020-01-01T00:00:00"}}'
    rows = spark.createDataFrame([(text,)], "raw_json string")
    run_silver(spark, lake, SMALL)
    put_bronze(spark, lake, [("later", "1")], at(60 * 30))
    run_silver(spark, lake, SMALL)
    late = rows.select(
        F.lit("k").alias("event_key"), "raw_json", F.lit("t").alias("topic"),
        F.lit(0).alias("partition"), F.lit(9).cast("bigint").alias("offset"),
        F.lit(at(60 * 31)).alias("kafka_timestamp"), F.lit(at(60 * 31)).alias("ingestion_time"),
    )
    stored = with_day(late, "ingestion_time", "ingestion_date")
    stored.write.mode("append").partitionBy("ingestion_date").parquet(lake.table("bronze_log"))
    assert run_silver(spark, lake, SMALL) == ["a", "later", "old"]


@pytest.fixture
def chained(spark, lake, small_sf):
    """All layers over the events in three drops in time order, then a closing edit.

    Each drop is a run of its own: it starts from the checkpoints of the last.
    """
    events = testbed.events(spark, small_sf)
    topic = f"{lake.root}/topic"
    cuts = [F.lit(c).cast("timestamp") for c in ("2024-01-11", "2024-01-21")]
    drops = [
        events.filter(F.col("ts") < cuts[0]),
        events.filter((F.col("ts") >= cuts[0]) & (F.col("ts") < cuts[1])),
        events.filter(F.col("ts") >= cuts[1]),
        testbed.closing_event(events),
    ]
    for drop in drops:
        publish(testbed.topic_rows(drop), path=topic)
        service.drain(spark, lake, topic_stream(spark, path=topic), SMALL)
    return events


def test_chain_over_restarts_equals_batch(spark, lake, chained):
    sent = testbed.bronze_rows(chained.unionByName(testbed.closing_event(chained)))
    assert read_layer(spark, lake, "bronze_log").count() == sent.count()
    broken = read_layer(spark, lake, "quarantine")
    assert broken.count() == silver.quarantine(sent).count()

    plain = [name for name in SILVER.fieldNames() if name != "processing_delay_seconds"]
    live = read_layer(spark, lake, "silver_log").select(*plain)
    batch = testbed.silver_rows(chained).unionByName(
        testbed.silver_rows(testbed.closing_event(chained))
    )
    assert rows_of(live) == rows_of(batch.select(*plain))

    counts = [n for n in GOLD.fieldNames() if n not in ("unique_editors", "active_pages")]
    kpis = read_layer(spark, lake, "gold_live").select(*counts)
    assert rows_of(kpis) == rows_of(gold.window_kpis(testbed.silver_rows(chained)).select(*counts))


def test_publishing_a_feed_reaches_silver(spark, lake, small_sf, tmp_path):
    feed, topic = str(tmp_path / "feed"), str(tmp_path / "topic")
    events = testbed.events(spark, small_sf)
    testbed.feed_lines(events).write.json(feed)
    lines = spark.readStream.schema("event string, data string").json(feed)
    layers.start_publish(
        lines, lake.checkpoint("publish"), path=topic, topic="t", trigger=layers.ONCE
    ).awaitTermination()
    service.drain(spark, lake, topic_stream(spark, path=topic), SMALL)
    assert read_layer(spark, lake, "silver_log").count() == events.count()
    # Messages without an id land in Bronze under the default key.
    unknown = read_layer(spark, lake, "quarantine").groupBy("event_key").count().collect()
    assert [tuple(r) for r in unknown] == [("unknown", events.count() // 50)]


def test_a_failing_layer_ends_the_service(spark, lake, tmp_path):
    """A topic of the wrong shape kills Bronze; the service must not go on."""
    topic = str(tmp_path / "topic")
    spark.range(3).select(F.lit(1).alias("key"), F.lit(2).alias("value")).write.parquet(topic)
    with pytest.raises(Exception):
        service.serve(spark, lake, topic_stream(spark, path=topic), SMALL, interval="1 second")
    assert spark.streams.active == []


def test_the_service_runs_until_a_query_is_stopped(spark, lake, small_sf):
    topic, events = f"{lake.root}/topic", testbed.events(spark, small_sf)
    publish(testbed.topic_rows(events), path=topic)
    running = Thread(
        target=service.serve,
        args=(spark, lake, topic_stream(spark, path=topic), SMALL, "1 second"),
    )
    running.start()
    deadline = time.monotonic() + 120
    while time.monotonic() < deadline:
        if path_exists(spark, f"{lake.table('gold_live')}/_spark_metadata/0"):
            break
        time.sleep(1)
    assert {q.name for q in spark.streams.active} == {
        "bronze_log", "silver_log", "quarantine", "gold_live"
    }
    next(q for q in spark.streams.active if q.name == "silver_log").stop()
    running.join(120)
    assert not running.is_alive()
    assert spark.streams.active == []
    assert read_layer(spark, lake, "silver_log").count() == events.count()


@pytest.mark.parametrize("layer", ["bronze_log", "silver_log", "gold_live"])
def test_a_batch_done_but_not_marked_is_not_written_twice(spark, lake, small_sf, layer):
    """As after a driver loss between the write and the checkpoint's commit."""
    topic = f"{lake.root}/topic"
    publish(testbed.topic_rows(testbed.events(spark, small_sf)), path=topic)
    service.drain(spark, lake, topic_stream(spark, path=topic), SMALL)
    before = rows_of(read_layer(spark, lake, layer))
    commits = Path(lake.checkpoint(layer)) / "commits"
    last = max((f for f in commits.iterdir() if f.name.isdigit()), key=lambda f: int(f.name))
    for left in (last, commits / f".{last.name}.crc"):
        left.unlink(missing_ok=True)
    service.drain(spark, lake, topic_stream(spark, path=topic), SMALL)
    assert rows_of(read_layer(spark, lake, layer)) == before
    assert last.exists()


def test_silver_files_per_batch_can_be_set(spark, lake):
    settings = replace(Settings(), dedup_splits=2, silver_files=1)
    put_bronze(spark, lake, [(str(i), "x") for i in range(50)], at(0))
    assert len(run_silver(spark, lake, settings)) == 50
    assert len(list(Path(lake.table("silver_log")).rglob("*.parquet"))) == 1


def test_kafka_source_settings():
    options = kafka_options("host:9092", "edits")
    assert options["subscribe"] == "edits"
    assert options["startingOffsets"] == "latest"
    assert options["failOnDataLoss"] == "false"
    assert int(options["maxOffsetsPerTrigger"]) > int(options["maxRecordsPerPartition"]) > 0
