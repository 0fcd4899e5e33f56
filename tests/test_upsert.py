"""Upsert into day-partitioned tables, and the replay built on it."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from editpulse import testbed
from editpulse.operators import gold, upsert
from editpulse.operators.dedup import first_per_key, latest_per_key
from editpulse.plans.replay import corrected_windows, run_replay, served_gold, with_day
from editpulse.schemas import GOLD, SILVER
from editpulse.sources.lake import list_paths, path_exists, read_layer, read_table, write_days
from helpers import at, rows_of, silver_df


def dated(spark, rows):
    return with_day(silver_df(spark, rows), "event_time", "event_date")


def stored(df, path):
    """A source must be stored: it is read several times."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [("a", at(0)), ("b", at(1), {"bytes_diff": 5}), ("c", at(60 * 24)), (None, at(2)), ("z", None)]
    write_days(dated(spark, rows), path, "event_date")
    return path


def content(spark, path):
    rows = read_table(spark, path).select("event_id", "event_time", "bytes_diff", "page_title")
    return {tuple(r) for r in rows.collect()}


def apply(spark, table, tmp_path, rows):
    return upsert.upsert_days(stored(dated(spark, rows), str(tmp_path / "source")), table)


def test_match_replaces_the_whole_row_and_the_rest_is_added(spark, table, tmp_path):
    before = content(spark, table)
    report = apply(
        spark, table, tmp_path,
        [("b", at(1), {"bytes_diff": None, "page_title": "Q"}), ("n", at(60 * 48))],
    )
    assert set(report.touched) == {date(2024, 1, 2), date(2024, 1, 4)} and report.emptied == ()
    gone = {("b", at(1), 5, "P")}
    new = {("b", at(1), None, "Q"), ("n", at(60 * 48), 0, "P")}
    assert content(spark, table) == (before - gone) | new


def test_twice_is_once(spark, table, tmp_path):
    rows = [("b", at(3), {"bytes_diff": 9}), ("n", at(5))]
    apply(spark, table, tmp_path, rows)
    once = rows_of(read_table(spark, table))
    apply(spark, table, tmp_path, rows)
    assert rows_of(read_table(spark, table)) == once


def test_an_edit_may_move_to_another_day_and_leave_an_empty_one(spark, table, tmp_path):
    report = apply(spark, table, tmp_path, [("c", at(10))])
    assert report.emptied == (date(2024, 1, 3),)
    assert ("c", at(10), 0, "P") in content(spark, table)
    assert read_table(spark, table).count() == 5
    assert not path_exists(spark, f"{table}/event_date=2024-01-03")


def test_edits_without_time_are_upserted_too(spark, table, tmp_path):
    report = apply(spark, table, tmp_path, [("z", at(4))])
    assert report.emptied == (None,)
    assert {r for r in content(spark, table) if r[0] == "z"} == {("z", at(4), 0, "P")}
    apply(spark, table, tmp_path, [("z", None, {"bytes_diff": 3})])
    assert {r for r in content(spark, table) if r[0] == "z"} == {("z", None, 3, "P")}


def test_rows_without_a_key_match_nothing(spark):
    target = silver_df(spark, [(None, at(0)), (None, at(1)), ("a", at(2))])
    source = silver_df(spark, [("a", at(2), {"bytes_diff": 1})])
    merged = upsert.merge(target, source)
    assert merged.count() == 3
    assert merged.filter("event_id IS NULL").count() == 2


def test_merge_statement_is_for_tables_that_take_it(spark):
    spark.sql("CREATE TABLE IF NOT EXISTS plain_table (event_id string) USING parquet")
    with pytest.raises(Exception, match="MERGE"):
        upsert.merge_into(spark.createDataFrame([("a",)], "event_id string"), "plain_table")


def test_first_write_makes_the_table(spark, tmp_path):
    path = str(tmp_path / "new")
    report = upsert.upsert_days(dated(spark, [("a", at(0))]), path)
    assert report.touched == (date(2024, 1, 2),)
    assert read_table(spark, path).count() == 1


def test_one_id_with_a_third_of_the_rows(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("at"),
        (F.col("id") * 7 % 1000).alias("payload"),
    )
    first = first_per_key(rows, ["k"], ["at"])
    last = latest_per_key(rows, ["k"], ["at"])
    assert first.count() == last.count() == 20_001
    assert first.filter("k = 'hot'").first().asDict() == {"k": "hot", "at": 0, "payload": 0}
    assert last.filter("k = 'hot'").first().asDict() == {"k": "hot", "at": 29997, "payload": 979}


# --- Replay -----------------------------------------------------------------


def land_bronze(lake, events, ingested=None, revisions=False):
    rows = testbed.bronze_rows(events, revisions)
    if ingested is not None:
        rows = rows.withColumn("ingestion_time", F.lit(ingested).cast("timestamp"))
    stored_rows = with_day(rows, "ingestion_time", "ingestion_date")
    stored_rows.write.mode("append").partitionBy("ingestion_date").parquet(lake.table("bronze_log"))


def expected_gold(events):
    return rows_of(gold.window_kpis(testbed.silver_rows(events)))


def corrected(spark, lake):
    return rows_of(read_layer(spark, lake, "gold_corrected").select(*GOLD.fieldNames()))


def test_first_replay_fills_and_later_ones_catch_up_after_a_gap(spark, lake, small_sf):
    events = testbed.events(spark, small_sf)
    early = events.filter(F.col("ts") < F.lit("2024-01-10").cast("timestamp"))
    middle = events.filter(
        (F.col("ts") >= F.lit("2024-01-10").cast("timestamp"))
        & (F.col("ts") < F.lit("2024-01-20").cast("timestamp"))
    )
    rest = events.filter(F.col("ts") >= F.lit("2024-01-20").cast("timestamp"))
    start = datetime(2024, 2, 1)
    land_bronze(lake, early, start)
    run_replay(spark, lake, start)
    assert corrected(spark, lake) == expected_gold(early)

    # No run for five days: the bound goes back to where the last one ended.
    land_bronze(lake, middle, start + timedelta(hours=2))
    land_bronze(lake, rest, start + timedelta(days=5))
    report = run_replay(spark, lake, start + timedelta(days=5))
    assert report.replayed_rows == events.count()
    assert corrected(spark, lake) == expected_gold(events)

    # Nothing new: nothing changes.
    before = rows_of(read_layer(spark, lake, "silver_serving"))
    run_replay(spark, lake, start + timedelta(days=5, hours=1))
    assert rows_of(read_layer(spark, lake, "silver_serving")) == before
    assert corrected(spark, lake) == expected_gold(events)
    assert not path_exists(spark, f"{lake.root}/_staging/x")


def test_a_broken_off_first_replay_is_made_whole_by_the_next(spark, lake, small_sf, monkeypatch):
    from editpulse.plans import replay as module

    events = testbed.events(spark, small_sf)
    start = datetime(2024, 2, 1)
    land_bronze(lake, events, start)

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(module.gold, "window_kpis", lost)
        with pytest.raises(RuntimeError):
            run_replay(spark, lake, start)
    assert path_exists(spark, lake.table("silver_serving"))
    # Two days later the first arrivals are older than the lookback.
    run_replay(spark, lake, start + timedelta(days=2))
    assert corrected(spark, lake) == expected_gold(events)


@pytest.mark.parametrize("step", ["upsert_days", "_redo_gold"])
def test_a_moved_edit_is_made_good_after_a_break(spark, lake, small_sf, monkeypatch, step):
    from editpulse.plans import replay as module

    events = testbed.events(spark, small_sf)
    land_bronze(lake, events)
    run_replay(spark, lake, datetime(2024, 1, 31))
    moved = events.filter("event_id % 10 = 0").withColumn("ts", F.col("ts") + F.expr("INTERVAL 3 DAYS"))
    land_bronze(lake, moved, datetime(2024, 2, 5))

    def lost(*_, **__):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(module, step, lost)
        with pytest.raises(RuntimeError):
            run_replay(spark, lake, datetime(2024, 2, 5, 1))
    run_replay(spark, lake, datetime(2024, 2, 5, 2))
    final = events.filter("event_id % 10 <> 0").unionByName(moved)
    assert corrected(spark, lake) == expected_gold(final)
    assert list_paths(spark, lake.staging("")) == []


def test_stored_reduced_windows_stay_whole(spark, lake, small_sf):
    events = testbed.events(spark, small_sf)
    land_bronze(lake, events)
    for hour in (6, 18):
        run_replay(spark, lake, datetime(2024, 1, 20, hour))
    expected = gold.replay_kpis(testbed.silver_rows(events), None)
    stored = read_layer(spark, lake, "gold_replay").drop("window_date")
    assert rows_of(stored) == rows_of(expected)


def test_replay_of_an_empty_bronze(spark, lake, small_sf):
    land_bronze(lake, testbed.events(spark, small_sf).filter("false"))
    report = run_replay(spark, lake, datetime(2024, 2, 1))
    assert (report.days, report.replayed_rows) == ((), 0)


def test_replay_leaves_days_alone_that_nothing_arrived_for(spark, lake, small_sf):
    events = testbed.events(spark, small_sf)
    land_bronze(lake, events)
    run_replay(spark, lake, datetime(2024, 1, 31))
    late = events.filter(F.col("event_id") == 999)
    land_bronze(lake, late, datetime(2024, 2, 5))
    report = run_replay(spark, lake, datetime(2024, 2, 5, 1))
    # The lookback starts where the last run ended, at the newest arrival then.
    assert len(report.days) <= 2
    assert corrected(spark, lake) == expected_gold(events)


def test_replay_recomputes_derived_columns(spark, lake, small_sf):
    events = testbed.events(spark, small_sf)
    land_bronze(lake, events, revisions=True)
    run_replay(spark, lake, datetime(2024, 1, 31))
    serving = read_layer(spark, lake, "silver_serving").select(*SILVER.fieldNames())
    from editpulse.operators.silver import classify

    again = classify(serving.drop("edit_size", "user_type")).select(*SILVER.fieldNames())
    assert rows_of(serving) == rows_of(again)


def test_served_gold_prefers_corrected_windows(spark, lake):
    live = gold.window_kpis(silver_df(spark, [("a", at(0)), ("b", at(10))]))
    write_days(with_day(live, "window_start", "window_date"), lake.table("gold_live"), "window_date")
    assert served_gold(spark, lake).count() == 2
    better = gold.window_kpis(silver_df(spark, [("a", at(0)), ("late", at(1)), ("c", at(20))]))
    write_days(
        with_day(better, "window_start", "window_date"), lake.table("gold_corrected"), "window_date"
    )
    rows = {r.window_start: r.total_edits for r in served_gold(spark, lake).collect()}
    assert rows == {at(0): 2, at(10): 1, at(20): 1}


def test_corrected_windows_start_whole(spark):
    rows = silver_df(spark, [("a", at(1)), ("b", at(4)), ("c", at(-1))])
    kpis = corrected_windows(rows, F.lit(at(3)).cast("timestamp"))
    assert [(r.window_start, r.total_edits) for r in kpis.collect()] == [(at(0), 2)]
