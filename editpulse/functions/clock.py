"""Clocks and time bounds. The clock is always an argument, never hidden."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Instant = Column | datetime | str | None


def instant(now: Instant = None) -> Column:
    """Clock as a column: the wall clock, a given moment, or a column."""
    if now is None:
        return F.current_timestamp()
    if isinstance(now, Column):
        return now
    return F.lit(now).cast("timestamp")


def hours(n: float) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(n))


def minutes(n: float) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(n))


def newest(df: DataFrame, time_col: str, less: Column | None = None) -> Column:
    """Latest moment in ``df``, less an interval, as a scalar subquery.

    Nothing is collected: Spark runs the subquery first. Compared with a time
    column as it is, its value reaches the scan and whole row groups are
    skipped; so a bound should be subtracted in here and not outside.
    """
    latest = F.max(time_col)
    return df.agg(latest if less is None else latest - less).scalar()


def since(df: DataFrame, time_col: str, bound: Column, date_col: str | None = None) -> DataFrame:
    """Rows at or after ``bound``.

    Spark cannot derive a partition filter from ``time_col`` alone, so the day
    partition column gets its own predicate and whole days are never opened.
    """
    recent = F.col(time_col) >= bound
    if date_col is not None:
        recent = recent & (F.col(date_col) >= F.to_date(bound))
    return df.filter(recent)
