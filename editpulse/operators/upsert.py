"""Keyed upsert into day-partitioned parquet tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editpulse.operators.id_index import IdIndex
from editpulse.sources.lake import drop_partition, path_exists, read_table, write_days

# Runs of an id index from which they are merged.
MERGE_RUNS = 16


def matched(source: DataFrame, target: DataFrame, key: str = "event_id") -> DataFrame:
    """Source rows that replace a target row."""
    return source.join(target.select(key), key, "left_semi")


def inserts(source: DataFrame, target: DataFrame, key: str = "event_id") -> DataFrame:
    """Source rows with no target row."""
    return source.join(target.select(key), key, "left_anti")


def merge(target: DataFrame, source: DataFrame, key: str = "event_id") -> DataFrame:
    """Target with source rows put in by key; source keys must be unique.

    A matched row is replaced whole, so nulls overwrite too. Target rows with
    a null key match nothing: they go round the join, else all of them would
    land in one task.
    """
    return _kept(target, source, key).unionByName(source.select(*target.columns))


def _kept(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    keyed = target.filter(F.col(key).isNotNull())
    keyless = target.filter(F.col(key).isNull())
    return keyed.join(source.select(key), key, "left_anti").unionByName(keyless)


def merge_into(source: DataFrame, table: str, key: str = "event_id") -> None:
    """The same upsert as one MERGE, for catalogs whose tables support it."""
    same_key = F.expr(f"{table}.{key} = source.{key}")
    merge_rows = source.alias("source").mergeInto(table, same_key)
    merge_rows.whenMatched().updateAll().whenNotMatched().insertAll().merge()


def in_days(date_col: str, days: list) -> Column:
    """Whether a row is of one of ``days``, of which one may be null."""
    known = [day for day in days if day is not None]
    match = F.col(date_col).isin(known)
    return match | F.col(date_col).isNull() if len(known) < len(days) else match


def _days_of(df: DataFrame, date_col: str) -> list:
    """Distinct days: at most one value per day partition of the table."""
    return [row[0] for row in df.select(date_col).distinct().collect()]


@dataclass(frozen=True)
class UpsertReport:
    """Days rewritten, and those among them that lost their last row."""

    touched: tuple[date | None, ...]
    emptied: tuple[date | None, ...] = ()


def touched_days(
    source: DataFrame,
    target: DataFrame | None,
    key: str = "event_id",
    date_col: str = "event_date",
    index: IdIndex | None = None,
) -> list[date | None]:
    """Days that hold source rows, or target rows that these replace.

    With an ``index`` the old days come from the buckets of the source's ids, and
    the target is not read; a day that an id has left since may be among them.
    Without one, two columns of the whole target are.
    """
    days = set(_days_of(source, date_col))
    if target is None:
        return list(days)
    if index is not None:
        _build_index(target, key, date_col, index)
        return list(days | set(_days_of(index.find(source, key), "day")))
    return list(days | set(_days_of(target.join(source.select(key), key, "left_semi"), date_col)))


def _build_index(target: DataFrame, key: str, date_col: str, index: IdIndex) -> None:
    """The one look-through, for a table that was there before its index."""
    if not index.exists(target.sparkSession):
        index.append(target, key, date_col)


def record_days(source: DataFrame, key: str, date_col: str, index: IdIndex) -> None:
    """Note the days of ``source`` before it is written.

    A run that breaks off in between leaves days in the index where no row came:
    they are looked at once more than needed. The other way round, rows would
    stand where the index does not know of them. The source's keys are unique.
    """
    index.append(source, key, date_col, unique=True)


def upsert_days(
    source: DataFrame,
    path: str,
    key: str = "event_id",
    date_col: str = "event_date",
    touched: list[date | None] | None = None,
    index: IdIndex | None = None,
) -> UpsertReport:
    """Merge ``source`` into the table at ``path``.

    Only the days that hold source rows, or target rows the source replaces
    (an edit may move to another day), are read in full and rewritten; give
    them as ``touched`` where they are known. With an ``index`` of the table's
    ids, which is kept up to date, no other day is looked at. Pass a stored
    source: it is read more than once. Each day is replaced as a whole; the days
    are not replaced together.
    """
    spark = source.sparkSession
    target = read_table(spark, path, source.schema) if path_exists(spark, path) else None
    touched = touched_days(source, target, key, date_col, index) if touched is None else touched
    if index is not None:
        record_days(source, key, date_col, index)
    if target is None:
        write_days(source, path, date_col)
        return UpsertReport(tuple(touched))

    result = merge(target.filter(in_days(date_col, touched)), source, key)

    # A day that lost its last row would keep its files: overwriting only
    # replaces days that get rows. Days that the source has rows of do.
    fresh = set(_days_of(source, date_col))
    left = [day for day in touched if day not in fresh]
    remaining = _days_of(_kept(target.filter(in_days(date_col, left)), source, key), date_col) if left else []
    emptied = tuple(day for day in left if day not in remaining)
    write_days(result, path, date_col)
    for day in emptied:
        drop_partition(spark, path, date_col, day)
    if index is not None and len(index.runs(spark)) > MERGE_RUNS:
        index.merge(spark)
    return UpsertReport(tuple(touched), emptied)
