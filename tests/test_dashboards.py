"""Dashboards take every row, whatever its labels."""

from pyspark.sql import functions as F

from editpulse.plans import dashboards
from helpers import at, silver_df


def test_every_kind_of_user_has_its_row(spark):
    rows = silver_df(spark, [("a", at(0)), ("b", at(1)), ("c", at(2)), ("d", at(3))])
    kind = F.when(F.col("event_id") == "a", "NEWCOMER").when(F.col("event_id") != "b", F.col("user_type"))
    got = dashboards.user_distribution(rows.withColumn("user_type", kind)).collect()
    assert {r.user_type: (r.edits, r.share_percentage) for r in got} == {
        "NEWCOMER": (1, 25.0), None: (1, 25.0), "REGISTERED": (2, 50.0),
    }


def test_live_edits_have_no_limit_of_their_own(spark):
    rows = silver_df(spark, [(f"e{i}", at(i)) for i in range(150)])
    assert dashboards.live_edits(rows).count() == 150
    assert [r.event_id for r in dashboards.live_edits(rows, limit=2).collect()] == ["e149", "e148"]
