"""Appending what is new of a micro-batch, once, whatever breaks off.

A batch goes through four steps, and each looks first whether it was done: its
new rows are stored aside, its ids go to the index as the run of the batch's
number, its files are moved to the table one by one, and its number is noted. A
batch that Spark runs again after a kill goes on where it stopped: it is held
against the index of the batches before it alone, so it finds its own ids new
again, and files that were moved are not there to be moved twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.config import Settings
from editpulse.functions.clock import Instant
from editpulse.operators import silver
from editpulse.operators.id_index import IdIndex
from editpulse.operators.upsert import MERGE_RUNS
from editpulse.sources.lake import LAYOUT, Lake, delete_path, list_paths, make_folder, path_exists, read_table, rename, stored_schema

TABLE = "silver_log"


def seen_index(lake: Lake, settings: Settings) -> IdIndex:
    return IdIndex(lake.index(TABLE), settings.index_buckets)


def unseen(batch: DataFrame, number: int, index: IdIndex, key: str = "event_id") -> DataFrame:
    """Rows whose id no batch before ``number`` had; opens the buckets of the batch's ids only."""
    known = index.find(batch, key, before=number).select(F.col("id").alias(key))
    return batch.join(known, key, "left_anti")


def _done(spark: SparkSession, folder: str) -> int:
    """The last batch that is wholly in the table, -1 before the first."""
    return max((int(p.rsplit("-", 1)[1]) for p in list_paths(spark, f"{folder}/done")), default=-1)


def _mark_done(spark: SparkSession, folder: str, number: int) -> None:
    make_folder(spark, f"{folder}/done/batch-{number}")
    for path in list_paths(spark, f"{folder}/done"):
        if int(path.rsplit("-", 1)[1]) < number:
            delete_path(spark, path)


def _move_files(spark: SparkSession, draft: str, table: str) -> None:
    """Finished files to their days; a reader of the table never sees a part of one.

    At most one file for each task and day of a batch.
    """
    for day in list_paths(spark, draft):
        name = day.rsplit("/", 1)[1]
        for file in list_paths(spark, day) if "=" in name else ():
            rename(spark, file, f"{table}/{name}/{file.rsplit('/', 1)[1]}")


def _only_state(batch: DataFrame) -> None:
    """Run a batch whose rows are stored already: its state has to be written all the same."""
    batch.write.format("noop").mode("overwrite").save()


def append_new(batch: DataFrame, number: int, lake: Lake, settings: Settings, now: Instant = None) -> None:
    """Append the rows of a micro-batch whose id is new to the Silver log; safe to run again."""
    spark, folder = batch.sparkSession, f"{lake.root.rstrip('/')}/_appends/{TABLE}"
    if number <= _done(spark, folder):
        _only_state(batch)
        return
    index, draft = seen_index(lake, settings), f"{folder}/batch-{number}"
    _, time_col, date_col = LAYOUT[TABLE]
    if path_exists(spark, f"{draft}/_SUCCESS"):
        _only_state(batch)
    else:
        batch = batch.persist()  # read for its buckets, its ids and its rows
        rows = silver.finish(unseen(batch, number, index), now)
        dated = rows.withColumn(date_col, F.to_date(time_col))
        dated.write.mode("overwrite").option("compression", "zstd").partitionBy(date_col).parquet(draft)
        batch.unpersist()
    index.append(read_table(spark, draft, stored_schema(TABLE)), "event_id", date_col, number)
    _move_files(spark, draft, lake.table(TABLE))
    _mark_done(spark, folder, number)
    delete_path(spark, draft)
    if len(index.runs(spark)) > MERGE_RUNS:
        # The last runs stay: their batches may still be run again.
        index.merge(spark, before=number)
