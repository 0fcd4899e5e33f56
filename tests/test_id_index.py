"""The index of ids: look-ups by bucket, crashes between its writes, and what is built on it."""

from dataclasses import replace
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from editpulse import testbed
from editpulse.config import Settings
from editpulse.operators import gold, upsert
from editpulse.operators.id_index import IdIndex
from editpulse.plans import replay
from editpulse.plans.replay import run_replay, with_day
from editpulse.schemas import GOLD
from editpulse.sources import lake as lakes
from editpulse.sources.lake import read_layer, read_table, write_days, write_layer
from editpulse.streaming import layers, long, service
from helpers import at, plan_of, rows_of, silver_df


def dated(spark, rows):
    return with_day(silver_df(spark, rows), "event_time", "event_date")


def stored(df, path):
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ids(spark, names, day="2024-01-02"):
    return spark.createDataFrame([(n, date.fromisoformat(day)) for n in names], "event_id string, event_date date")


def found(index, spark, names, **limits):
    rows = index.find(ids(spark, names), "event_id", **limits).collect()
    return {(r.id, r.day.isoformat()) for r in rows}


def test_only_the_buckets_of_the_ids_are_read(spark, tmp_path):
    index = IdIndex(str(tmp_path / "index"), buckets=32)
    index.append(ids(spark, [f"e{i}" for i in range(2000)]), "event_id", "event_date")
    looked = index.find(ids(spark, ["e7"]), "event_id")
    bucket = looked.collect()[0].bucket
    plan = plan_of(looked).split("PartitionFilters: ")[1].split("]")[0]
    assert f"= {bucket}" in plan or f"IN ({bucket})" in plan
    files = spark.read.parquet(f"{index.root}/run=000000000000").filter(F.col("bucket") == bucket)
    assert files.count() < 200
    assert found(index, spark, ["e7", "e1999", "nothing", None]) == {("e7", "2024-01-02"), ("e1999", "2024-01-02")}


def test_runs_are_read_together_and_merged(spark, tmp_path):
    index = IdIndex(str(tmp_path / "index"), buckets=4)
    index.append(ids(spark, ["a", "b", "b"]), "event_id", "event_date")
    index.append(ids(spark, ["b"], "2024-01-05"), "event_id", "event_date")
    index.append(ids(spark, ["changed"]), "event_id", "event_date", number=1)  # is there: stays as it is
    both = {("a", "2024-01-02"), ("b", "2024-01-02"), ("b", "2024-01-05")}
    assert found(index, spark, ["a", "b", "changed"]) == both
    assert found(index, spark, ["b"], before=1) == {("b", "2024-01-02")}
    index.append(ids(spark, ["c"]), "event_id", "event_date")
    index.merge(spark, before=2)
    assert found(index, spark, ["a", "b", "c"]) == {("a", "2024-01-02"), ("b", "2024-01-05"), ("c", "2024-01-02")}
    assert len(index.runs(spark)) == 2 and index.next_number(spark) == 3


def test_a_known_table_is_not_read_for_its_days(spark, tmp_path):
    path, index = str(tmp_path / "table"), IdIndex(str(tmp_path / "index"))
    write_days(dated(spark, [("a", at(0)), ("c", at(60 * 24)), ("z", None)]), path, "event_date")
    source = stored(dated(spark, [("c", at(5)), ("z", at(60 * 48))]), str(tmp_path / "source"))
    upsert.touched_days(source, read_table(spark, path), index=index)
    unreadable = read_table(spark, path).withColumn("event_id", F.raise_error(F.lit("read")).cast("string"))
    days = upsert.touched_days(source, unreadable, index=index)
    assert set(days) == {date(2024, 1, 2), date(2024, 1, 3), date(2024, 1, 4), None}


@pytest.mark.parametrize("broken", [False, True])
def test_edits_that_move_are_found(spark, tmp_path, monkeypatch, broken):
    path, index = str(tmp_path / "table"), IdIndex(str(tmp_path / "index"), 4)
    start = [("a", at(0)), ("b", at(1)), ("c", at(60 * 24)), ("z", None), (None, at(3))]
    upsert.upsert_days(stored(dated(spark, start), str(tmp_path / "s0")), path, index=index)
    steps = [[("c", at(10))], [("c", at(60 * 24 * 3)), ("z", at(4))], [("b", None), ("c", at(60 * 24))]]
    now = dict(start[:4])
    for number, rows in enumerate(steps):
        source = stored(dated(spark, rows), str(tmp_path / f"s{number + 1}"))
        if broken:
            with monkeypatch.context() as patch, pytest.raises(OSError):
                patch.setattr(upsert, "write_days", lambda *_: (_ for _ in ()).throw(OSError("killed")))
                upsert.upsert_days(source, path, index=index)
        upsert.upsert_days(source, path, index=index)
        now |= dict(rows)
        table = read_table(spark, path).filter("event_id IS NOT NULL")
        assert {(r.event_id, r.event_time) for r in table.collect()} == set(now.items())
        assert table.count() == len(now)


def test_runs_of_a_table_are_merged_in_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(upsert, "MERGE_RUNS", 2)
    path, index = str(tmp_path / "table"), IdIndex(str(tmp_path / "index"), 2)
    for day in range(4):
        source = stored(dated(spark, [("a", at(60 * 24 * day)), (f"n{day}", at(0))]), str(tmp_path / f"s{day}"))
        upsert.upsert_days(source, path, index=index)
    assert len(index.runs(spark)) <= 3
    assert rows_of(read_table(spark, path).select("event_id")) == [("a",), ("n0",), ("n1",), ("n2",), ("n3",)]


# --- The long dedup -----------------------------------------------------------

LONG = replace(Settings(), dedup_horizon="1 hour", dedup_splits=1, index_buckets=4)


def put_bronze(spark, lake, names, arrival):
    texts = [(f'{{"meta":{{"id":"{i}"}},"title":"t"}}', n) for n, i in enumerate(names)]
    rows = spark.createDataFrame(texts, "raw_json string, offset bigint").select(
        F.lit("k").alias("event_key"), "raw_json", F.lit("t").alias("topic"), F.lit(0).alias("partition"), "offset",
        F.lit(arrival).alias("kafka_timestamp"), F.lit(arrival).alias("ingestion_time"),
    )
    rows = with_day(rows, "ingestion_time", "ingestion_date")
    rows.write.mode("append").partitionBy("ingestion_date").parquet(lake.table("bronze_log"))


def run_long(spark, lake, settings=LONG):
    layers.start_silver_long(spark, lake, settings, layers.ONCE).awaitTermination()


def silver_ids(spark, lake):
    return sorted(r.event_id for r in read_layer(spark, lake, "silver_log").collect())


def test_copies_beyond_the_horizon_do_not_come_through(spark, lake):
    service._prepare(spark, lake)
    for day in range(4):
        put_bronze(spark, lake, ["a", "b", f"n{day}", f"n{day}"], at(60 * 24 * day))
        run_long(spark, lake)
    assert silver_ids(spark, lake) == ["a", "b", "n0", "n1", "n2", "n3"]


def test_a_horizon_is_needed(spark, lake):
    with pytest.raises(ValueError):
        layers.start_silver_long(spark, lake)


@pytest.mark.parametrize("step", ["unseen", "append", "_move_files", "_mark_done", "second file"])
def test_a_batch_run_again_after_a_kill_adds_nothing(spark, lake, monkeypatch, step):
    service._prepare(spark, lake)
    put_bronze(spark, lake, ["a", "b"], at(0))
    run_long(spark, lake)
    put_bronze(spark, lake, ["a", *(f"n{i}" for i in range(40))], at(60 * 24))
    calls = []

    def die(*_, **__):
        raise OSError("killed")

    def die_on_second(spark_, path, to):
        calls.append(path)
        return die() if len(calls) == 2 else lakes.rename(spark_, path, to)

    with monkeypatch.context() as patch:
        if step == "second file":
            patch.setattr(long, "rename", die_on_second)
        elif step == "append":
            patch.setattr(IdIndex, "append", die)
        else:
            patch.setattr(long, step, die)
        with pytest.raises(Exception, match="killed"):
            run_long(spark, lake)
    run_long(spark, lake)
    assert silver_ids(spark, lake) == sorted(["a", "b", *(f"n{i}" for i in range(40))])
    put_bronze(spark, lake, ["n3", "new"], at(60 * 48))
    run_long(spark, lake)
    assert silver_ids(spark, lake) == sorted(["a", "b", "new", *(f"n{i}" for i in range(40))])


def test_gold_reads_what_the_long_dedup_appends(spark, lake):
    service._prepare(spark, lake)
    rows = [f'{i}"}},"dt2":"' for i in range(3)]
    put_bronze(spark, lake, rows, at(0))
    run_long(spark, lake)
    query = layers.start_gold(spark, lake, trigger=layers.ONCE)
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == read_layer(spark, lake, "silver_log").count()


# --- Gold by windows ------------------------------------------------------------


def test_only_touched_windows_are_done_again(spark, lake, small_sf):
    events = testbed.events(spark, small_sf)

    def land(rows):
        rows = with_day(rows, "ingestion_time", "ingestion_date")
        rows.write.mode("append").partitionBy("ingestion_date").parquet(lake.table("bronze_log"))

    land(testbed.bronze_rows(events))
    now = events.agg(F.max("ts")).first()[0] + timedelta(days=2)
    run_replay(spark, lake, now)
    # A mark in every window shows which of them are written anew.
    marked = read_layer(spark, lake, "gold_corrected").withColumn("total_edits", F.lit(-1).cast("long"))
    copy = stored(marked, str(lake.root) + "/copy")
    write_layer(copy, lake, "gold_corrected")
    one = events.filter("event_id = 500")
    then = one.first().ts
    moved = one.withColumn("ts", F.col("ts") + F.expr("INTERVAL 3 HOURS"))
    land(testbed.bronze_rows(moved).withColumn("ingestion_time", F.lit(now)))
    run_replay(spark, lake, now)
    gold_rows = read_layer(spark, lake, "gold_corrected").drop("window_date")
    fresh = {r.window_start for r in gold_rows.filter("total_edits >= 0").collect()}
    floor = lambda t: t - timedelta(minutes=t.minute % 5, seconds=t.second, microseconds=t.microsecond)
    edits = events.filter("event_id <> 500").unionByName(moved)
    want = gold.window_kpis(testbed.silver_rows(edits))
    assert fresh == {floor(then), floor(then + timedelta(hours=3))} & {r.window_start for r in want.collect()}
    same = [F.col("window_start").isin(list(fresh))]
    assert rows_of(gold_rows.filter(same[0]).select(*GOLD.fieldNames())) == rows_of(want.filter(same[0]))
    assert {r.window_start for r in gold_rows.collect()} == {r.window_start for r in want.collect()}


def test_edits_that_did_not_change_touch_no_window(spark):
    old = silver_df(spark, [("a", at(0)), ("b", at(7)), ("c", at(20))])
    new = silver_df(spark, [("a", at(0)), ("b", at(31)), ("d", at(50)), ("e", None)])
    rows = replay.touched_windows(new, old, [5, 10]).collect()
    starts = {(r.minutes, int((r.window_start - at(0)).total_seconds() // 60)) for r in rows}
    assert starts == {(5, 5), (5, 30), (5, 50), (10, 0), (10, 30), (10, 50)}
