"""Documents through five of the training-text operators, one stage after the other.

Each stage works on what the one before kept, written as Parquet and read again.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.llm import exchange
from editpulse.llm.decontaminate import decontaminate
from editpulse.llm.jaccard import drop_near_copies
from editpulse.llm.lines import drop_repeated_lines
from editpulse.llm.mixing import mix
from editpulse.llm.queries import importable, table
from editpulse.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines go that match a line of an earlier document, or an earlier one of the same."""
    return drop_repeated_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five words, 0.8 alike."""
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark go, and documents that are little else."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with ``copies``, how often it takes each."""
    return mix(docs).filter(F.col("copies") > 0)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
]

# SQL cannot express the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    importable(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = exchange.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
