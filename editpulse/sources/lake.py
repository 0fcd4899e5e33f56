"""Tables of the lake: where they live, how they are made, read and written.

Log tables (``*_log``, ``gold_live``, ``quarantine``) are written by streams
alone and are never rewritten: a stream's own file log hides other writers, and
a rewrite under a stream would feed every row again. Serving tables are written
by batch jobs alone, whole days at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType, StructField, StructType

from editpulse import schemas
from editpulse.session import settings, shuffle_width

# Shuffled bytes per writing task.
WRITE_TASK_BYTES = "512MB"

# Documents are stored at a tenth of their size or less, and a task reads whole row
# groups: a topic has small ones, and a replay reads few of them in a task.
LOG_GROUP_BYTES = 32 << 20
LOG_READ_BYTES = "16MB"

# table -> (columns, time column behind the day partition, partition column)
LAYOUT: dict[str, tuple[StructType, str, str]] = {
    "bronze_log": (schemas.BRONZE, "ingestion_time", "ingestion_date"),
    "quarantine": (schemas.BRONZE, "ingestion_time", "ingestion_date"),
    "silver_log": (schemas.SILVER, "event_time", "event_date"),
    "gold_live": (schemas.GOLD, "window_start", "window_date"),
    "silver_serving": (schemas.SILVER, "event_time", "event_date"),
    "gold_corrected": (schemas.GOLD, "window_start", "window_date"),
    "gold_replay": (schemas.REPLAY_GOLD, "window_start", "window_date"),
}


@dataclass(frozen=True)
class Lake:
    """A root folder every executor can reach, and the format of its tables.

    Parquet tables are read and written by path. Tables of any other format are
    those of ``database``, by name: their own format keeps their files, takes
    ``MERGE`` and has its own upkeep.
    """

    root: str
    fmt: str = "parquet"
    database: str | None = None

    def __post_init__(self):
        if self.by_name and not self.database:
            raise ValueError(f"tables of format {self.fmt} need a database")

    @property
    def by_name(self) -> bool:
        return self.fmt != "parquet"

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def checkpoint(self, query: str) -> str:
        return f"{self.root.rstrip('/')}/_checkpoints/{query}"

    def index(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/_index/{table}"

    def staging(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/_staging/{name}"


def stored_schema(table: str) -> StructType:
    """Declared columns plus the day the table is partitioned by."""
    columns, _, date_col = LAYOUT[table]
    return StructType([*columns.fields, StructField(date_col, DateType())])


def create_tables(spark: SparkSession, lake: Lake, database: str) -> None:
    """Register every table over the lake's folders; safe to repeat."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table, (_, _, date_col) in LAYOUT.items():
        columns = ", ".join(
            f"`{field.name}` {field.dataType.simpleString()}" for field in stored_schema(table)
        )
        stored = "" if lake.by_name else f" LOCATION '{lake.table(table)}' OPTIONS (compression 'zstd')"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}) USING {lake.fmt} "
            f"PARTITIONED BY ({date_col}){stored}"
        )


def register_views(spark: SparkSession, lake: Lake) -> list[str]:
    """Temp views over the tables there are, for SQL without a catalog."""
    found = [table for table in LAYOUT if path_exists(spark, lake.table(table))]
    for table in found:
        read_layer(spark, lake, table).createOrReplaceTempView(table)
    return found


def sync_partitions(spark: SparkSession, lake: Lake, database: str) -> None:
    """Tell the catalog which days the batch-written tables hold now.

    Log tables need none: readers follow the stream's own file log. Tables by
    name need none either.
    """
    for table in () if lake.by_name else LAYOUT:
        path = lake.table(table)
        if path_exists(spark, path) and not is_stream_log(spark, path):
            spark.sql(f"MSCK REPAIR TABLE {database}.{table} SYNC PARTITIONS")
            spark.catalog.refreshTable(f"{database}.{table}")


def _path(spark: SparkSession, path: str):
    """Hadoop path and its file system, whatever the scheme."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _path(spark, path)
    return fs.exists(hadoop_path)


def make_folder(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _path(spark, path)
    fs.mkdirs(hadoop_path)


def delete_path(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _path(spark, path)
    fs.delete(hadoop_path, True)


def list_paths(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing if it is not there."""
    if not path_exists(spark, path):
        return []
    hadoop_path, fs = _path(spark, path)
    return [status.getPath().toString() for status in fs.listStatus(hadoop_path)]


def move_into(spark: SparkSession, path: str, folder: str) -> None:
    """Move a file into a folder, which is made where it is missing."""
    hadoop_path, fs = _path(spark, path)
    make_folder(spark, folder)
    fs.rename(hadoop_path, _path(spark, f"{folder}/{hadoop_path.getName()}")[0])


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Put a file or a folder in another place, in one step on a file system that can."""
    make_folder(spark, to.rsplit("/", 1)[0])
    hadoop_path, fs = _path(spark, path)
    if not fs.rename(hadoop_path, _path(spark, to)[0]):
        raise OSError(f"could not rename {path} to {to}")


def set_time(spark: SparkSession, path: str, millis: int) -> None:
    """Give a file another time of change; file streams take older files first."""
    hadoop_path, fs = _path(spark, path)
    fs.setTimes(hadoop_path, millis, -1)


def is_stream_log(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/_spark_metadata")


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_layer(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    """A lake table in its declared schema, so an empty folder reads as empty."""
    if lake.by_name:
        return spark.table(lake.name(table))
    return read_table(spark, lake.table(table), stored_schema(table))


def layer_exists(spark: SparkSession, lake: Lake, table: str) -> bool:
    return spark.catalog.tableExists(lake.name(table)) if lake.by_name else path_exists(spark, lake.table(table))


def write_layer(df: DataFrame, lake: Lake, table: str) -> None:
    """Replace the days present in ``df`` of a lake table."""
    date_col = LAYOUT[table][2]
    if lake.by_name:
        df.hint("rebalance", date_col).writeTo(lake.name(table)).overwritePartitions()
    else:
        write_days(df, lake.table(table), date_col)


def drop_day(spark: SparkSession, lake: Lake, table: str, day) -> None:
    """Take all rows of a day out of a lake table."""
    date_col = LAYOUT[table][2]
    if lake.by_name:
        same = f"{date_col} IS NULL" if day is None else f"{date_col} = DATE '{day.isoformat()}'"
        spark.sql(f"DELETE FROM {lake.name(table)} WHERE {same}")
    else:
        drop_partition(spark, lake.table(table), date_col, day)


def write_days(df: DataFrame, path: str, date_col: str) -> None:
    """Replace the days present in ``df``, other days stay.

    The rebalance brings a day's rows together into well-sized files and lets
    adaptive execution split a day that is too big for one task. Its tasks are
    larger than those of other shuffles, so that compaction has nothing to do
    after each replay.
    """
    how = {
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": WRITE_TASK_BYTES,
        "spark__sql__parquet__outputTimestampType": "TIMESTAMP_MICROS",
    }
    with settings(df.sparkSession, **how, **shuffle_width(df)):
        (
            df.hint("rebalance", date_col)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy(date_col)
            .parquet(path)
        )


def drop_partition(spark: SparkSession, path: str, date_col: str, day) -> None:
    value = "__HIVE_DEFAULT_PARTITION__" if day is None else day.isoformat()
    delete_path(spark, f"{path}/{date_col}={value}")
