"""Settings of the edit-stream jobs, in one place."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: labels and thresholds every layer agrees on -------------
LARGE_EDIT_BYTES = 500

SIZE_LARGE = "LARGE"
SIZE_REMOVAL = "LARGE_REMOVAL"
SIZE_SMALL = "SMALL"

USER_BOT = "BOT"
USER_ANONYMOUS = "ANONYMOUS"
USER_REGISTERED = "REGISTERED"

TREND_UP = "GROWING"
TREND_DOWN = "SHRINKING"
TREND_FLAT = "STABLE"

UNKNOWN_KEY = "unknown"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Settings:
    """Widths, horizons and limits of the running jobs."""

    kpi_minutes: int = 5
    watermark: str = "10 minutes"
    replay_minutes: int = 10
    lookback_hours: int = 24

    # Streaming dedup: how long an id is remembered (arrival time), and into
    # how many parts the copies of one id are split before they meet. None
    # keeps every id for ever; a horizon bounds the state, lets copies that
    # come later through, and needs a Bronze log in order of arrival.
    dedup_horizon: str | None = None
    dedup_splits: int = 32

    # Files per batch and day of the Silver log. Its state has as many parts as
    # there are shuffle tasks; on a wide cluster that many files are too small.
    silver_files: int | None = None

    # Buckets of the index that knows the day of every id; a look-up opens those
    # of the ids it is asked for. A few million ids to a bucket are a good size.
    index_buckets: int = 64

    # Age from which files that no log knows may be deleted; a running batch
    # may have written files that are not committed yet.
    orphan_hours: int = 24

    # Where a first start of the Kafka source begins, and whether offsets that
    # the broker no longer has end the query.
    starting_offsets: str = "latest"
    fail_on_data_loss: bool = False

    # Rate limits of the streaming sources.
    max_offsets_per_trigger: int = 20_000_000
    max_records_per_task: int = 500_000
    max_files_per_trigger: int = 1_000


@dataclass(frozen=True)
class TableRule:
    """Maintenance limits of one table."""

    max_age_hours: int
    keep_versions: int
    target_file_bytes: int
    min_input_files: int = 5


# --- Fixed values: maintenance limits per layer ----------------------------
TABLE_RULES = {
    "bronze": TableRule(max_age_hours=3, keep_versions=12, target_file_bytes=134217728),
    "silver": TableRule(max_age_hours=2, keep_versions=8, target_file_bytes=268435456),
    "gold": TableRule(max_age_hours=2, keep_versions=5, target_file_bytes=536870912),
}
# ---------------------------------------------------------------------------
