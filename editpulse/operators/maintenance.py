"""Retention, orphan detection and compaction.

The first three functions only name candidates. Deleting and rewriting are
separate calls.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from editpulse.config import TableRule
from editpulse.functions.clock import Instant, hours, instant
from editpulse.session import settings
from editpulse.sources.lake import delete_path, is_stream_log

# A file below this share of the target counts as small. With five or more
# outputs none of them is, so a compacted day is not picked again.
SMALL_SHARE = 0.75

# Output files per rewrite job; more than that goes into further jobs.
MAX_FILES_PER_JOB = 2_000

DELETES_AT_ONCE = 32

# A curve over two columns tells this many stretches of each apart (a power of two),
# cut by a drawn sample of about so many rows. Both decide the layout alone.
CURVE_BITS = 6
CURVE_SAMPLE = 20_000

_DAY_MICROS = 24 * 60 * 60 * 1_000_000


def expired_versions(
    versions: DataFrame,
    rules: dict[str, TableRule],
    now: Instant = None,
    table: str = "table",
    version: str = "version",
    committed: str = "committed_at",
) -> DataFrame:
    """Versions older than their table's age limit and not among its newest.

    Both must hold; tables without a rule keep everything. The newest few per
    table are found first: that ranking has a limit Spark applies in every map
    task, so a table with most of the versions is not sorted in one task.
    """
    known = versions.filter(F.col(table).isin(list(rules)))
    age_limit = _by_table(table, {name: hours(r.max_age_hours) for name, r in rules.items()})
    keep = _by_table(table, {name: F.lit(r.keep_versions) for name, r in rules.items()})

    by_age = Window.partitionBy(table).orderBy(F.desc(committed), F.desc(version))
    kept = (
        known.select(table, version, committed)
        .withColumn("age_rank", F.row_number().over(by_age))
        .filter(F.col("age_rank") <= max(r.keep_versions for r in rules.values()))
        .filter(F.col("age_rank") <= keep)
        .select(table, version)
    )
    old = known.filter(F.col(committed) < instant(now) - age_limit)
    return old.join(kept, [table, version], "left_anti")


def _by_table(table: str, values: dict[str, Column]) -> Column:
    """The value of the row's table."""
    return F.coalesce(*[F.when(F.col(table) == name, value) for name, value in values.items()])


def orphan_files(
    listing: DataFrame,
    referenced: DataFrame,
    older_than: Column,
    path: str = "path",
    modified: str = "modified_at",
) -> DataFrame:
    """Listed files that nothing refers to, old enough not to be in the making."""
    old = listing.filter(F.col(modified) < older_than)
    return old.join(referenced.select(path), path, "left_anti")


def compaction_plan(
    files: DataFrame,
    target_bytes: int,
    min_input_files: int,
    partition: str = "partition",
    size: str = "bytes",
) -> DataFrame:
    """Partitions worth rewriting and into how many files.

    A partition qualifies by its number of small files, and only if the
    rewrite leaves fewer files than there are.
    """
    small = F.col(size) < target_bytes * SMALL_SHARE
    return (
        files.groupBy(partition)
        .agg(
            F.count("*").alias("input_files"),
            F.count_if(small).alias("small_files"),
            F.sum(size).alias("input_bytes"),
        )
        .withColumn(
            "output_files",
            F.greatest(F.ceil(F.col("input_bytes") / target_bytes), F.lit(1)).cast("bigint"),
        )
        .filter(
            (F.col("small_files") >= min_input_files)
            & (F.col("output_files") < F.col("input_files"))
        )
    )


def list_files(spark: SparkSession, path: str, date_col: str | None = None) -> DataFrame:
    """Every data file under ``path``: path, bytes, modified_at and its day.

    File contents are not read. For a table written by a stream this lists
    also the files its log does not know, which is what orphans are.
    """
    with settings(spark, spark__sql__streaming__fileStreamSink__ignoreMetadata="true"):
        found = _listing(spark, path)
    return found if date_col is None else found.withColumn("partition", _day(date_col))


def committed_files(spark: SparkSession, path: str) -> DataFrame:
    """Files a reader of the table sees: those in the stream's own log."""
    return _listing(spark, path)


def _listing(spark: SparkSession, path: str) -> DataFrame:
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified_at"))
    )
    # Only file status is looked up: a task per file would be all overhead.
    return listed.coalesce(spark.sparkContext.defaultParallelism)


def _day(date_col: str) -> Column:
    return F.regexp_extract("path", f"/{date_col}=([^/]+)/", 1)


def delete_files(candidates: DataFrame, dry_run: bool = True) -> int:
    """Delete the files in column ``path``; returns how many there are."""
    if dry_run:
        return candidates.count()
    spark, paths = candidates.sparkSession, candidates.select("path").toLocalIterator()
    deleted = 0
    with ThreadPoolExecutor(DELETES_AT_ONCE) as pool:
        # Some at a time: the driver never holds the names of all of them.
        while some := [row.path for row in islice(paths, 100 * DELETES_AT_ONCE)]:
            list(pool.map(lambda path: delete_path(spark, path), some))
            deleted += len(some)
    return deleted


def _jobs(plan: list, limit: int) -> list[list]:
    """Plan rows cut into groups of at most ``limit`` output files."""
    groups, room = [], 0
    for row in sorted(plan, key=lambda r: r.partition):
        if not groups or row.output_files > room:
            groups.append([])
            room = limit
        groups[-1].append(row)
        room -= row.output_files
    return groups


def compact_days(
    spark: SparkSession,
    path: str,
    date_col: str,
    target_bytes: int,
    min_input_files: int = 5,
    max_files_per_job: int = MAX_FILES_PER_JOB,
    time_col: str | None = None,
    key_col: str | None = None,
) -> list[str]:
    """Rewrite the days that hold many small files; returns those days.

    A file holds a stretch of its day by ``time_col``, in order, so that readers
    still skip files and row groups by time. Rows of one time at a cut, or all of
    them without a time, are spread by the file and position they come from,
    which a retried task repeats exactly. With ``key_col``, a text column, files
    follow a curve over the time of the day and the key, so that readers skip by
    either one, though by time less than without. Each job replaces its days whole, so a
    stop in between loses nothing.
    """
    if is_stream_log(spark, path):
        raise ValueError(f"{path} is written by a stream; compact the serving table instead")
    files = list_files(spark, path, date_col)
    # One row per day partition at most.
    plan = compaction_plan(files, target_bytes, min_input_files).collect()
    for job in _jobs(plan, max_files_per_job):
        _rewrite(spark, path, date_col, job, time_col, key_col)
    return sorted(row.partition for row in plan)


def _read_days(spark: SparkSession, path: str, date_col: str) -> DataFrame:
    """The table with its day as a date, also when no day is known."""
    found = spark.read.parquet(path).schema
    day = StructField(date_col, DateType())
    fields = [day if field.name == date_col else field for field in found.fields]
    return spark.read.schema(StructType(fields)).parquet(path)


def _time_bounds(rows: DataFrame, date_col: str, layout: list) -> dict:
    """Times, or places on a curve, that cut each day into its files, about equal in rows."""
    most = max(slots for _, _, slots in layout)
    if most == 1:
        return {}
    wanted = {day: slots for day, _, slots in layout}
    found = {}
    for slots in sorted(set(wanted.values()) - {1}):
        days = [day for day, n in wanted.items() if n == slots and day is not None]
        cut = F.percentile_approx("_clock", [i / slots for i in range(1, slots)]).alias("bounds")
        of = rows.filter(F.col(date_col).isin(days)).groupBy(F.col(date_col).alias("day")).agg(cut)
        found.update({row.day: list(row.bounds) for row in of.collect()})
    return found


def _cuts(values: list) -> list:
    """Values that cut sorted ones into stretches of about equal length."""
    parts = 1 << CURVE_BITS
    return [values[len(values) * i // parts] for i in range(1, parts)] if values else []


def _stretch(value: Column, cuts: list, first: int = 0) -> Column:
    """Number of the stretch that the value falls into, by halving."""
    if not cuts:
        return F.lit(first)
    middle = len(cuts) // 2
    below = _stretch(value, cuts[:middle], first)
    return F.when(value < cuts[middle], below).otherwise(_stretch(value, cuts[middle + 1 :], first + middle + 1))


def _curve(rows: DataFrame, clock: Column, key_col: str) -> DataFrame:
    """``rows`` with their place ``_clock`` on a curve over time of day and key, bit by bit in turn."""
    moment = F.pmod(clock, F.lit(_DAY_MICROS))
    key = F.coalesce(F.col(key_col).cast("string"), F.lit(""))
    both = rows.select(moment.alias("moment"), key.alias("key"))
    # Two columns of at most about CURVE_SAMPLE rows come to the driver.
    drawn = both.sample(min(1.0, CURVE_SAMPLE / max(both.count(), 1)), seed=7).collect()
    rows = rows.withColumn("_moment", _stretch(moment, _cuts(sorted(r.moment for r in drawn))))
    rows = rows.withColumn("_key", _stretch(key, _cuts(sorted(r.key for r in drawn))))
    place = F.lit(0).cast("bigint")
    for bit in range(CURVE_BITS):
        for name, shift in (("_key", 2 * bit), ("_moment", 2 * bit + 1)):
            one = F.shiftright(name, bit).bitwiseAND(F.lit(1)).cast("bigint")
            place = place + one * (1 << shift)
    return rows.withColumn("_clock", place)


def _rewrite(
    spark: SparkSession, path: str, date_col: str, job: list, time_col: str | None, key_col: str | None
) -> None:
    table = _read_days(spark, path, date_col)
    layout, first = [], 0
    for row in job:
        known = row.partition != "__HIVE_DEFAULT_PARTITION__"
        layout.append((date.fromisoformat(row.partition) if known else None, first, row.output_files))
        first += row.output_files
    days = [day for day, _, _ in layout if day is not None]
    chosen = F.col(date_col).isin(days)
    if len(days) < len(layout):
        chosen = chosen | F.col(date_col).isNull()

    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    clock = F.unix_micros(time_col) if time_col else F.lit(None).cast("bigint")
    rows = table.filter(chosen).withColumn("_place", place)
    clock = F.coalesce(clock, F.lit(0).cast("bigint"))
    rows = _curve(rows, clock, key_col) if key_col else rows.withColumn("_clock", clock)
    bounds = _time_bounds(rows, date_col, layout) if time_col or key_col else {}
    slots = spark.createDataFrame(
        [(*entry, bounds.get(entry[0], [0] * (entry[2] - 1))) for entry in layout],
        "day date, first_slot bigint, slots bigint, bounds array<bigint>",
    )
    # One row per day of the job, with as many bounds as it has files.
    rows = rows.join(F.broadcast(slots), F.col(date_col).eqNullSafe(F.col("day")))
    below = F.size(F.filter("bounds", lambda b: b < F.col("_clock")))
    upto = F.size(F.filter("bounds", lambda b: b <= F.col("_clock")))
    slot = F.col("first_slot") + below + F.pmod("_place", upto - below + 1)
    placed = rows.withColumn("_slot", slot.cast("int")).repartitionById(first, "_slot")
    placed = placed.sortWithinPartitions("_clock", *([key_col] if key_col else []))
    with settings(spark, spark__sql__parquet__outputTimestampType="TIMESTAMP_MICROS"):
        (
            placed.select(*table.columns)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy(date_col)
            .parquet(path)
        )
