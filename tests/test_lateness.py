"""Late rows as the engine's watermarks tell them, against live Gold's own count of dropped rows."""

import pytest

from editpulse.streaming import lateness, layers, progress
from helpers import at, silver_df
from editpulse.plans.replay import with_day


def feed(spark, lake, times):
    rows = with_day(silver_df(spark, [(f"e{t}", None if t is None else at(t)) for t in times]), "event_time", "event_date")
    rows.write.mode("append").partitionBy("event_date").parquet(lake.table("silver_log"))


def run(spark, lake):
    progress.supervise(spark, lake, lambda: lateness.start_late(spark, lake, trigger=layers.ONCE))
    gold = layers.start_gold(spark, lake, trigger=layers.ONCE)
    gold.awaitTermination()
    return sum(o.numRowsDroppedByWatermark for p in gold.recentProgress for o in p.stateOperators)


def late(spark, lake):
    return sorted(r.event_id for r in lateness.late_rows(spark, lake).collect())


def test_late_rows_are_those_that_gold_drops(spark, lake):
    # The end of each window decides: :06 is in a window that ends at :10.
    steps = [[1, 4, 7], [20, None], [2, 13], [40, 3], [29, 31, 8], [60]]
    dropped = sum([feed(spark, lake, times) or run(spark, lake) for times in steps])
    assert late(spark, lake) == ["e2", "e29", "e3", "e8"]
    assert dropped == 4


def test_a_batch_run_again_adds_nothing(spark, lake, monkeypatch):
    feed(spark, lake, [30])
    run(spark, lake)
    feed(spark, lake, [1, 28])
    keep = lateness.keep_candidates

    def killed(*args):
        keep(*args)
        raise OSError("killed")

    with monkeypatch.context() as patch, pytest.raises(Exception, match="killed"):
        patch.setattr(lateness, "keep_candidates", killed)
        lateness.start_late(spark, lake, trigger=layers.ONCE).awaitTermination()
    run(spark, lake)
    assert late(spark, lake) == ["e1"]
