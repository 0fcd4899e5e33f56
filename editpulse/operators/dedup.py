"""One row per key, batch and stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    """The picked row as an aggregate, so copies collapse before the shuffle.

    Every map task sends at most one row per key. A key that holds a third of
    the table therefore costs its reducer one row per map task. Rows equal in
    ``order`` are ordered by a hash of the rest, so that the pick is no chance.
    """
    rest = [name for name in df.columns if name not in keys]
    best = pick(F.struct(*rest), F.struct(*order, F.xxhash64(*rest))).alias("picked")
    return df.groupBy(*keys).agg(best).select(*keys, "picked.*").select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row lowest in ``order`` for every key."""
    return _pick(df, keys, order, F.min_by)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row highest in ``order`` for every key."""
    return _pick(df, keys, order, F.max_by)


def dedup_stream(
    rows: DataFrame,
    key: str,
    clock: str,
    horizon: str | None,
    splits: int = 1,
    split_on: Sequence[str] = ("partition", "offset"),
) -> DataFrame:
    """Stateful dedup of a stream, first arrival wins.

    With a horizon, an id is forgotten once ``clock`` has moved that far past
    it, so state is bounded by the horizon's traffic. ``clock`` should be the
    arrival time: it never runs backwards, so no late edit is dropped here.
    Without a horizon ids are kept for ever.

    ``splits`` above 1 first dedups every id in that many parts, so a hot id is
    shared by as many tasks; the parts then meet in a second pass that sees at
    most ``splits`` rows per id. It costs a second state store, whatever their
    number.
    """
    if horizon is None:
        stream, drop = rows, DataFrame.dropDuplicates
    else:
        stream, drop = rows.withWatermark(clock, horizon), DataFrame.dropDuplicatesWithinWatermark
    if splits > 1:
        part = F.pmod(F.xxhash64(*split_on), F.lit(splits))
        stream = drop(stream.withColumn("_part", part), [key, "_part"]).drop("_part")
    return drop(stream, [key])
