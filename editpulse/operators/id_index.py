"""Where an id was stored before: an index in files, looked up by bucket.

An index is a folder of runs. Every write adds a run, put in place by one rename,
so that a reader sees it whole or not at all. A run holds a file or more for each
bucket of a hash of the id, sorted by id and with bloom filters. A look-up opens
only the buckets of the ids it is asked for. Many runs are merged to one now
and then; runs are never changed.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.session import settings
from editpulse.sources.lake import WRITE_TASK_BYTES, delete_path, list_paths, rename

_ENTRIES = "id string, day date, run string, bucket int"
MERGED = "m"  # ends the name of a run that holds all before it, too


@dataclass(frozen=True)
class IdIndex:
    """Entries of (id, day). The number of buckets is part of the path: another number is another index."""

    path: str
    buckets: int = 64

    @property
    def root(self) -> str:
        return f"{self.path.rstrip('/')}/of={self.buckets}"

    def bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def runs(self, spark: SparkSession) -> list[str]:
        """Names of the runs that hold all entries: the last merged one and what came after."""
        names = sorted(p.rsplit("run=", 1)[1] for p in list_paths(spark, self.root) if "/run=" in p)
        merged = [name for name in names if name.endswith(MERGED)]
        last = merged[-1] if merged else ""
        return [name for name in names if name == last or (not name.endswith(MERGED) and name > last)]

    def exists(self, spark: SparkSession) -> bool:
        return bool(self.runs(spark))

    def next_number(self, spark: SparkSession) -> int:
        runs = self.runs(spark)
        return 1 + int(runs[-1].removesuffix(MERGED)) if runs else 0

    def entries(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """(id, day, run, bucket) of all runs, or of those with a smaller number."""
        runs = [r for r in self.runs(spark) if before is None or int(r.removesuffix(MERGED)) < before]
        if not runs:
            return spark.createDataFrame([], _ENTRIES)
        paths = [f"{self.root}/run={run}" for run in runs]
        return spark.read.schema(_ENTRIES).option("basePath", self.root).parquet(*paths)

    def find(self, rows: DataFrame, key: str, before: int | None = None) -> DataFrame:
        """The entries of the ids in ``rows``, from the buckets of these ids alone."""
        spark = rows.sparkSession
        asked = rows.filter(F.col(key).isNotNull()).select(F.col(key).alias("id"), self.bucket(key).alias("bucket"))
        # At most one value for each bucket.
        hit = [row.bucket for row in asked.select("bucket").distinct().collect()]
        found = self.entries(spark, before).filter(F.col("bucket").isin(hit))
        return found.join(asked, ["bucket", "id"], "left_semi").select("id", "day", "run", "bucket")

    def _publish(self, entries: DataFrame, name: str) -> None:
        spark, draft = entries.sparkSession, f"{self.path.rstrip('/')}/_writing/{uuid.uuid4().hex}"
        with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes=WRITE_TASK_BYTES):
            (
                entries.hint("rebalance", "bucket")
                .sortWithinPartitions("bucket", "id")
                .write.option("compression", "zstd")
                .option("parquet.bloom.filter.enabled#id", "true")
                .partitionBy("bucket")
                .parquet(draft)
            )
        rename(spark, draft, f"{self.root}/run={name}")

    def append(
        self, rows: DataFrame, key: str, day: str, number: int | None = None, unique: bool = False
    ) -> None:
        """Add a run with the distinct ids and days of ``rows``; a number that is there already stays as it is.

        ``unique`` says that no id comes twice: nothing is shuffled to find that out.
        """
        spark = rows.sparkSession
        number = self.next_number(spark) if number is None else number
        name = f"{number:012d}"
        if name in self.runs(spark):
            return
        ids = rows.filter(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(day).alias("day"))
        ids = ids if unique else ids.distinct()
        self._publish(ids.withColumn("bucket", self.bucket("id")), name)

    def merge(self, spark: SparkSession, before: int | None = None) -> None:
        """All runs to one, with the day of the last run for each id, and drop the runs it replaces.

        Only where no upsert is under way: an id's day in its last run is then
        where its row stands. A reader that still has the old runs open fails and
        is run again; there is one writer.
        """
        old = [r for r in self.runs(spark) if before is None or int(r.removesuffix(MERGED)) < before]
        if len(old) < 2:
            return
        entries = self.entries(spark, before).groupBy("bucket", "id").agg(F.max_by("day", "run").alias("day"))
        self._publish(entries, old[-1].removesuffix(MERGED) + MERGED)
        for name in old:
            delete_path(spark, f"{self.root}/run={name}")
