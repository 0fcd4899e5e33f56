"""The maintenance run over a lake."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from editpulse.config import TABLE_RULES, Settings
from editpulse.functions.clock import Instant, hours, instant
from editpulse.operators import maintenance as m
from editpulse.sources.lake import LAYOUT, Lake, is_stream_log, path_exists

# Which rule holds for which lake table.
_RULE_OF = {
    "bronze_log": "bronze",
    "quarantine": "bronze",
    "silver_log": "silver",
    "silver_serving": "silver",
    "gold_live": "gold",
    "gold_corrected": "gold",
    "gold_replay": "gold",
}


LEAST_ORPHAN_HOURS = 24


@dataclass(frozen=True)
class UpkeepReport:
    orphans: dict[str, int]
    compacted: dict[str, list[str]]


def run_upkeep(
    spark: SparkSession,
    lake: Lake,
    now: Instant = None,
    delete: bool = False,
    orphan_hours: int = Settings.orphan_hours,
    cluster_pages: bool = False,
) -> UpkeepReport:
    """Find orphans of the stream logs, compact the serving tables.

    Orphans are counted and left in place unless ``delete`` is given. Only
    stream logs can have them: batch writes move finished files into place. A
    batch that still runs has files that no log knows yet, so nothing younger
    than a day is ever deleted. ``cluster_pages`` lays compacted edits out by time and
    page, where readers ask for pages as often as for times.
    """
    if delete and orphan_hours < LEAST_ORPHAN_HOURS:
        raise ValueError(f"files younger than {LEAST_ORPHAN_HOURS} hours may belong to a running batch")
    orphans, compacted = {}, {}
    if lake.by_name:
        raise ValueError(f"tables of format {lake.fmt} have their own upkeep")
    for table, (_, time_col, date_col) in LAYOUT.items():
        path, rule = lake.table(table), TABLE_RULES[_RULE_OF[table]]
        if not path_exists(spark, path):
            continue
        if is_stream_log(spark, path):
            cutoff = instant(now) - hours(orphan_hours)
            found = m.orphan_files(
                m.list_files(spark, path), m.committed_files(spark, path), cutoff
            )
            orphans[table] = m.delete_files(found, dry_run=not delete)
        else:
            paged = cluster_pages and table == "silver_serving"
            compacted[table] = m.compact_days(
                spark,
                path,
                date_col,
                rule.target_file_bytes,
                rule.min_input_files,
                time_col=time_col,
                key_col="page_title" if paged else None,
            )
    return UpkeepReport(orphans, compacted)
