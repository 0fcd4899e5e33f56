"""Boundary rows of parsing, classifying and publishing."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from editpulse.operators import gold, silver
from editpulse.sources.feed import envelopes
from helpers import at, bronze_df, rows_of, silver_df

NOT_EDITS = ["not json", "[1]", '{"meta":{"id":"1"', "{}", '{"meta":null}', '{"meta":{"id":null}}']


def test_blank_texts_are_dropped_and_broken_ones_are_set_aside(spark):
    bronze = bronze_df(spark, [None, "", " \t\n", *NOT_EDITS, '{"meta":{"id":"9"}}'])
    assert silver.parse(bronze).count() == len(NOT_EDITS) + 1
    assert [r.event_id for r in silver.extract(bronze).collect()] == ["9"]
    aside = silver.quarantine(bronze)
    assert aside.columns == bronze.columns
    assert sorted(r.raw_json for r in aside.collect()) == sorted(NOT_EDITS)


@pytest.mark.parametrize(
    "fields, column, value",
    [
        ('"user":"Bob"', "user_id", None),
        ('"user":{"id":3,"is_bot":true}', "user_id", 3),
        ('"title":"T"', "page_title", "T"),
        ('"length":{"new":7}', "bytes_diff", None),
        ('"length":{"old":7}', "bytes_diff", None),
        ('"length":{"old":7,"new":9}', "bytes_diff", 2),
        ('"length":{"old":-2147483648,"new":2147483647}', "bytes_diff", None),
    ],
)
def test_one_bad_field_spoils_only_itself(spark, fields, column, value):
    text = '{"meta":{"id":"1","dt":"2024-01-01T00:00:00.5"},%s}' % fields
    row = silver.extract(bronze_df(spark, [text])).first()
    assert row.event_id == "1"
    assert row.event_time == datetime(2024, 1, 1, 0, 0, 0, 500000)
    assert row[column] == value


@pytest.mark.parametrize(
    "dt, expected",
    [
        ('"nope"', None),
        ("1704067200", datetime(2024, 1, 1)),
        ('"2024-01-01T02:00:00+02:00"', datetime(2024, 1, 1)),
        ('"2024-01-01T00:00:00Z"', datetime(2024, 1, 1)),
    ],
)
def test_event_time_forms(spark, dt, expected):
    text = '{"meta":{"id":"1","dt":%s}}' % dt
    assert silver.extract(bronze_df(spark, [text])).first().event_time == expected


def test_feed_shape_reads_user_name_and_top_level_flag(spark):
    texts = [
        '{"meta":{"id":"1"},"user":"Ann","bot":false}',
        '{"meta":{"id":"2"},"user":"Robo","bot":true}',
        '{"meta":{"id":"3"},"bot":false}',
        '{"meta":{"id":"4"},"user":"Ann","bot":false}',
    ]
    rows = {r.event_id: r for r in silver.clean(bronze_df(spark, texts), shape="feed").collect()}
    kinds = [rows[i].user_type for i in "1234"]
    assert kinds == ["REGISTERED", "BOT", "ANONYMOUS", "REGISTERED"]
    assert rows["1"].user_id == rows["4"].user_id != rows["2"].user_id
    # The declared shape sees neither in such a document.
    assert {r.user_type for r in silver.clean(bronze_df(spark, texts)).collect()} == {"ANONYMOUS"}


@pytest.mark.parametrize(
    "diff, label",
    [(500, "SMALL"), (501, "LARGE"), (-500, "SMALL"), (-501, "LARGE_REMOVAL"), (None, "SMALL")],
)
def test_edit_size_bounds(spark, diff, label):
    assert silver_df(spark, [("1", at(0), {"bytes_diff": diff})]).first().edit_size == label


@pytest.mark.parametrize(
    "is_bot, user_id, label",
    [
        (True, 1, "BOT"),
        (True, None, "BOT"),
        (None, None, "ANONYMOUS"),
        (False, None, "ANONYMOUS"),
        (False, 2, "REGISTERED"),
        (None, 3, "REGISTERED"),
    ],
)
def test_user_type_order(spark, is_bot, user_id, label):
    rows = [("1", at(0), {"is_bot": is_bot, "user_id": user_id})]
    assert silver_df(spark, rows).first().user_type == label


def test_delay_floors_both_sides_and_may_be_negative(spark):
    df = spark.sql(
        "SELECT timestamp'2024-01-01 00:00:01.9' AS event_time, "
        "timestamp'2024-01-01 00:00:03.1' AS later, timestamp'2024-01-01 00:00:00.5' AS sooner"
    )
    delay = lambda now: silver.with_delay(df, F.col(now)).first().processing_delay_seconds
    assert delay("later") == 2
    assert delay("sooner") == -1


def test_first_arrival_wins_in_batch(spark):
    texts = ['{"meta":{"id":"1"},"title":"%s"}' % t for t in ("first", "second")]
    assert [r.page_title for r in silver.clean(bronze_df(spark, texts)).collect()] == ["first"]


def test_kpis_of_hard_values(spark):
    rows = [
        ("1", at(0), {"bytes_diff": -2147483648}),
        ("2", at(1), {"bytes_diff": None, "user_id": None}),
        ("3", at(2), {"bytes_diff": 600, "is_bot": True}),
        ("4", None, {"bytes_diff": 1}),
        ("5", at(7), {"bytes_diff": None, "is_bot": None, "user_id": None}),
    ]
    first, second = gold.window_kpis(silver_df(spark, rows)).orderBy("window_start").collect()
    assert (first.total_edits, first.unique_editors) == (3, 1)
    assert (first.bot_edits, first.human_edits) == (1, 2)
    assert first.volatility_score == 2147483648 + 600
    assert first.avg_bytes_per_edit == (600 - 2147483648) / 2
    assert (first.large_edits_count, first.revert_like_edits) == (2, 1)
    assert first.knowledge_trend == "SHRINKING"
    assert second.net_bytes_added is None and second.knowledge_trend == "STABLE"
    assert (second.unique_editors, second.human_edits) == (0, 1)


def test_rate_follows_the_window_width(spark):
    rows = [(str(i), at(i)) for i in range(10)]
    assert gold.window_kpis(silver_df(spark, rows), minutes=10).first().edits_per_minute == 1.0


def test_replay_counts_an_unknown_flag_on_no_side(spark):
    rows = [("1", at(0), {"is_bot": None}), ("2", at(1), {"is_bot": True}), ("3", at(2))]
    row = gold.replay_kpis(silver_df(spark, rows), F.lit(at(0)).cast("timestamp")).first()
    assert (row.total_edits, row.bot_edits, row.human_edits) == (3, 1, 1)


def test_replay_bound_is_inclusive(spark):
    rows = [("1", at(0)), ("2", at(-0.001)), ("3", None)]
    kpis = gold.replay_kpis(silver_df(spark, rows), F.lit(at(0)).cast("timestamp"))
    assert [r.total_edits for r in kpis.collect()] == [1]


def test_envelopes(spark):
    lines = [
        ("message", '{"meta":{"id":"a"},"x":1}'),
        ("message", '{"meta":{}}'),
        ("message", '{"meta":{"id":null}}'),
        ("message", ' { } \n'),
        ("heartbeat", '{"meta":{"id":"b"}}'),
        (None, '{"meta":{"id":"b"}}'),
        *[("message", text) for text in ("not json", "[1]", '"s"', "12", "null", "", None)],
        ("message", '{"meta":{"id":"c"}'),
        ("message", '{"meta":{"id":"c"}} tail'),
        ("message", "{'meta':{'id':'c'}}"),
        ("message", '{"x":[1,2}'),
        ("message", '[{"meta":{"id":"c"}}]'),
    ]
    sent = envelopes(spark.createDataFrame(lines, "event string, data string"))
    assert rows_of(sent) == sorted(
        [
            ("a", '{"meta":{"id":"a"},"x":1}'),
            ("unknown", '{"meta":{}}'),
            ("unknown", '{"meta":{"id":null}}'),
            ("unknown", " { } \n"),
        ],
        key=str,
    )
