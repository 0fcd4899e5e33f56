"""Blocks of documents and shards of keys, and what passes between them.

A block is the documents of one hash of the id, a few megabytes of text. It
sends each shard (a range of the key space) its distinct keys in one row, as
packed numbers, and gets back which of them matter. Keys of hot documents are
thus made distinct before the shuffle, and no row holds more than a block's
share of a shard.
"""

from __future__ import annotations

import gc
import math
import time
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.llm.text import U64

BLOCK_BYTES = 8 << 20
LAST_ID = np.iinfo(np.int64).max


def parts(docs: DataFrame, text_col: str, block_bytes: int = BLOCK_BYTES) -> int:
    """Number of blocks, and of shards, that the texts of ``docs`` make."""
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(1, math.ceil(total / block_bytes))


def blocks(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """Block number, id and text of every row; rows of one id share a block."""
    block = F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(n)).cast("int")
    return docs.select(
        block.alias("block"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")
    )


def ids_of(table: pa.Table) -> np.ndarray:
    """Ids for comparison: a null id comes after all others."""
    return table["id"].combine_chunks().fill_null(LAST_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def shard_edges(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's share begins in sorted keys (one more at the end)."""
    of = ((keys >> U64(32)) * U64(shards)) >> U64(32)
    return np.searchsorted(of, np.arange(shards + 1, dtype=U64))


def narrow(values: np.ndarray) -> bytes:
    """Non-negative or negative whole numbers, in four bytes each where they fit."""
    if len(values) and 0 <= values.min() and values.max() < 1 << 32:
        return b"4" + values.astype(np.uint32).tobytes()
    return b"8" + values.astype(np.int64).tobytes()


def widen(packed: bytes) -> np.ndarray:
    kind = np.uint32 if packed[:1] == b"4" else np.int64
    return np.frombuffer(packed, kind, offset=1).astype(np.int64)


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new folder in the one that the cluster shares."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        shared = tempfile.mkdtemp(prefix="editpulse-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: what follows does not redo it."""
    path = scratch(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy(spark: SparkSession) -> None:
    """Let shuffle files of finished steps go: they do with the objects that stand for them, which are few and small.

    The first round lets go of the plans, the second of what these held.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)


def discard(df: DataFrame) -> None:
    """Delete what ``stored`` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    tidy(spark)


def repeated_keys(shipped: DataFrame) -> DataFrame:
    """Keys that two blocks or more sent; ``shipped`` has shard, block and u32 keys."""

    def find(table: pa.Table) -> pa.Table:
        rows = [np.frombuffer(x, np.uint32) for x in table["keys"].to_pylist()]
        all_keys = np.concatenate(rows)
        all_keys.sort()
        twice = np.unique(all_keys[1:][all_keys[1:] == all_keys[:-1]])
        keep = [r[np.isin(r, twice, assume_unique=True)].tobytes() for r in rows]
        return pa.table(
            {"shard": table["shard"].cast(pa.int32()), "block": table["block"].cast(pa.int32()), "keys": pa.array(keep, pa.binary())}
        )

    return shipped.groupBy("shard").applyInArrow(find, "shard int, block int, keys binary")


def ship_keys(block: int, keys: np.ndarray, shards: int) -> pa.Table:
    """Distinct keys of a block as one row for each shard, 32 bits of each key."""
    keys = np.unique(keys)
    edges = shard_edges(keys, shards)
    low = (keys & U64(0xFFFFFFFF)).astype(np.uint32)
    used = np.flatnonzero(np.diff(edges))
    return pa.table(
        {
            "shard": pa.array(used.astype(np.int32)),
            "block": pa.array(np.full(len(used), block, np.int32)),
            "keys": pa.array([np.sort(low[edges[s] : edges[s + 1]]).tobytes() for s in used], pa.binary()),
        }
    )


def known(keys: np.ndarray, answers: pa.Table, shards: int) -> np.ndarray:
    """Which keys are among those that the shards sent back."""
    if not answers.num_rows or not len(keys):
        return np.zeros(len(keys), bool)
    wanted = [
        (U64(shard) << U64(32)) | np.frombuffer(low, np.uint32).astype(U64)
        for shard, low in zip(answers["shard"].to_pylist(), answers["keys"].to_pylist())
    ]
    of = ((keys >> U64(32)) * U64(shards)) >> U64(32)
    return np.isin((of << U64(32)) | (keys & U64(0xFFFFFFFF)), np.concatenate(wanted))
