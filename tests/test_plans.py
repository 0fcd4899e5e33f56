"""What the plans must look like to hold at scale."""

import re
from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from editpulse import testbed
from editpulse.config import TableRule
from editpulse.functions.clock import hours, newest, since
from editpulse.operators import gold, maintenance, silver, upsert
from editpulse.operators.dedup import first_per_key
from editpulse.plans import dashboards
from editpulse.plans.replay import with_day
from editpulse.schemas import SILVER
from editpulse.session import scratch_dir, settings, shuffle_width
from helpers import plan_of

# These write tables or run streams, so building them already runs jobs.
EAGER = {
    "silver_upsert_table", "day_partition_counts", "compaction_rowcheck", "bronze_ingest",
    "silver_stream", "gold_stream", "chain_available_now", "late_correction",
    "silver_stream_horizon", "gold_served", "gold_replay_stored", "replay_after_break",
    "quarantine_stream", "ddl_tables", "orphan_files", "compaction_plan",
}


@pytest.fixture(scope="module")
def events(spark, small_sf):
    return testbed.events(spark, small_sf)


@pytest.fixture(scope="module")
def lake_table(spark, events, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "silver")
    rows = testbed.silver_rows(events).drop("ingestion_time")
    with_day(rows, "event_time", "event_date").write.partitionBy("event_date").parquet(path)
    return spark.read.parquet(path)


def test_a_document_is_parsed_once(events):
    assert plan_of(silver.clean(testbed.bronze_rows(events))).count("from_json(") == 1


def test_lookback_prunes_days_and_reaches_the_scan(lake_table):
    bound = F.lit(datetime(2024, 1, 20, 12)).cast("timestamp")
    plan = plan_of(since(lake_table, "event_time", bound, "event_date"))
    assert re.search(r"PartitionFilters: \[[^\]]*event_date[^\]]*>= 2024-01-20", plan)
    assert "GreaterThanOrEqual(event_time,2024-01-20" in plan


def test_lookback_by_the_newest_row_prunes_days_too(lake_table):
    bound = newest(lake_table, "event_time") - hours(24)
    recent = since(lake_table, "event_time", bound, "event_date").select("event_id")
    recent.collect()
    scan = recent._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*event_date[^\]]*Subquery", scan)


def test_lookback_by_the_newest_row_skips_row_groups(spark, lake_table):
    """Without the day predicate too: the files of older days give no rows."""
    bound = newest(lake_table, "event_time", less=hours(24))
    recent = since(lake_table, "event_time", bound).select("event_id")
    with settings(spark, spark__sql__adaptive__enabled="false"):
        kept = len(recent.collect())
        scan = recent._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    read = scan.metrics().apply("numOutputRows").value()
    assert 0 < kept <= read < lake_table.count() / 10


def read_schema(df):
    return re.search(r"ReadSchema: struct<([^>]*)>", plan_of(df)).group(1)


def test_reports_read_only_their_columns(lake_table):
    assert read_schema(dashboards.top_pages(lake_table)) == "page_title:string"
    assert read_schema(dashboards.user_distribution(lake_table)) == "user_type:string"
    assert read_schema(dashboards.velocity(lake_table)) == "event_time:timestamp"


@pytest.mark.parametrize("distinct", ["exact", "approx"])
def test_kpis_aggregate_before_they_shuffle(lake_table, distinct):
    plan = plan_of(gold.window_kpis(lake_table, distinct=distinct))
    below = plan[plan.index("Exchange"):]
    assert "partial_" in below
    assert plan.count("Exchange hashpartitioning") == (2 if distinct == "exact" else 1)


def test_dedup_aggregates_before_it_shuffles(lake_table):
    plan = plan_of(first_per_key(lake_table, ["event_id"], ["event_time"]))
    assert plan.count("Exchange") == 1
    assert "partial_min_by" in plan[plan.index("Exchange"):]


def test_retention_ranks_before_it_shuffles(events):
    versions = events.select(
        F.col("event_type").alias("table"), F.col("event_id").alias("version"),
        F.col("ts").alias("committed_at"),
    )
    rules = {"click": TableRule(max_age_hours=2, keep_versions=5, target_file_bytes=0)}
    plan = plan_of(maintenance.expired_versions(versions, rules, datetime(2024, 1, 20)))
    ranked = plan[plan.index("WindowGroupLimit"):]
    assert re.search(r"WindowGroupLimit.*Partial", ranked)


def test_upsert_of_few_rows_does_not_shuffle_the_table(lake_table):
    source = lake_table.filter("event_date = '2024-01-30'").select(*SILVER.fieldNames())
    merged = upsert.merge(lake_table.select(*SILVER.fieldNames()), source)
    assert "Exchange hashpartitioning" not in plan_of(merged)


def test_top_pages_sorts_only_the_top(lake_table):
    assert "TakeOrderedAndProject" in plan_of(dashboards.top_pages(lake_table))


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - EAGER))
def test_no_query_crosses_or_leaves_the_jvm(spark, small_sf, name):
    plan = plan_of(entry.queries()[name](spark, small_sf))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas"):
        assert operator not in plan


def test_shuffles_widen_with_the_data(spark, lake_table):
    name = "spark__sql__adaptive__coalescePartitions__initialPartitionNum"
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    assert shuffle_width(lake_table)[name] == usual
    assert int(shuffle_width(lake_table, task_bytes=1000)[name]) > int(usual)


def test_scratch_tables_go_where_the_cluster_says(spark, tmp_path):
    """The setting is fixed when a session starts, so a stand-in carries it."""
    known = {"spark.checkpoint.dir": f"{tmp_path}/"}
    cluster = SimpleNamespace(conf=known)
    first, second = scratch_dir(cluster, "x"), scratch_dir(cluster, "x")
    assert first.startswith(f"{tmp_path}/editpulse-x-") and first != second
    assert not scratch_dir(spark, "x").startswith(str(tmp_path))


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(ValueError):
        with settings(spark, spark__sql__shuffle__partitions="77"):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "77"
            raise ValueError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
