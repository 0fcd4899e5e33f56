"""Sketches, documents of drifting shape, the state of the dedup, and supervised queries."""

from dataclasses import replace

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from editpulse.config import Settings
from editpulse.operators import sketches, variant
from editpulse.sources.lake import read_layer
from editpulse.streaming import layers, progress, service
from helpers import at, bronze_df, rows_of, silver_df
from test_id_index import put_bronze


def test_unions_of_windows_are_the_sketch_of_all(spark):
    rows = [(f"e{i}", at(i % 600), {"user_id": i % 3000, "page_title": f"P{i % 40}"}) for i in range(9000)]
    stored = sketches.window_sketches(silver_df(spark, rows))
    whole = sketches.roll_up(stored, F.date_trunc("day", "window_start")).first()
    assert whole.total_edits == 9000
    assert abs(whole.unique_editors - 3000) <= 3000 * 3 * sketches.STANDARD_ERROR
    assert whole.active_pages == 40
    top = {r.page_title: r.edits for r in sketches.top_pages(stored, 1000).collect()}
    assert top == {f"P{i}": 225 for i in range(40)}
    assert sketches.top_pages(stored, 3).count() == 3


def test_windows_without_a_known_user(spark):
    rows = [("a", at(0), {"user_id": None, "page_title": None}), ("b", None)]
    stored = sketches.window_sketches(silver_df(spark, rows).filter("event_time IS NOT NULL"))
    assert tuple(sketches.roll_up(stored, F.col("window_start")).first())[1:] == (1, 0, 0)
    assert sketches.top_pages(stored, 5).collect() == []


def test_reasons_and_kept_fields(spark):
    texts = [
        None, " \n", "{", '"text"', "7", "[]", "{}", '{"meta":{}}', '{"meta":7}', '{"meta":{"id":null}}',
        '{"meta":{"id":"a"},"user":"Bob","bot":true,"new":{"x":1}}',
        '{"meta":{"id":"b","dt":"nope"},"user":{"id":5,"is_bot":false},"length":{"old":1,"new":"x"}}',
        '{"meta":{"id":"c"},"user":7,"length":{"new":2147483647,"old":-1}}',
    ]
    bronze = bronze_df(spark, texts)
    reasons = {r.offset: r.reason for r in variant.quarantined(bronze).collect()}
    assert reasons == {2: "not json", 3: "not an object", 4: "not an object", 5: "not an object", 6: "no id", 7: "no id", 8: "no id", 9: "no id"}
    rows = {r.event_id: r for r in variant.flat_edits(bronze).collect()}
    assert set(rows) == {"a", "b", "c"}
    assert rows["a"].user_id is not None and rows["a"].is_bot and rows["a"].unknown_fields == ["new"]
    assert (rows["b"].event_time, rows["b"].user_id, rows["b"].bytes_diff) == (None, 5, None)
    assert (rows["c"].user_id, rows["c"].bytes_diff, rows["c"].unknown_fields) == (None, None, [])


def test_the_state_forgets_with_the_horizon(spark, lake):
    settings = replace(Settings(), dedup_horizon="1 hour", dedup_splits=1)
    service._prepare(spark, lake)
    for day, names in enumerate((["a", "b"], ["c"], ["d"])):
        put_bronze(spark, lake, names, at(60 * 24 * day))
        layers.start_silver(spark, lake, settings, layers.ONCE).awaitTermination()
    assert rows_of(service.remembered_ids(spark, lake)) == [("d",)]
    assert read_layer(spark, lake, "silver_log").count() == 4


def test_a_failing_query_is_started_again_with_growing_waits(spark, lake):
    service._prepare(spark, lake)
    put_bronze(spark, lake, ["a", "b"], at(0))
    waits, fail = [], F.raise_error(F.lit("killed")).cast("timestamp")

    def start(broken):
        return lambda: layers.start_silver(
            spark, lake, trigger=layers.ONCE, now=fail if len(waits) < broken else None
        )

    with pytest.raises(StreamingQueryException):
        progress.supervise(spark, lake, start(99), attempts=3, wait=1.0, sleep=waits.append)
    assert waits == [1.0, 2.0]
    waits.clear()
    assert progress.supervise(spark, lake, start(2), wait=1.0, sleep=waits.append) == 2
    assert waits == [1.0, 2.0]
    assert [tuple(r) for r in progress.totals(spark, lake).collect()] == [("silver_log", 2, 0, 1)]
    assert read_layer(spark, lake, "silver_log").count() == 2
