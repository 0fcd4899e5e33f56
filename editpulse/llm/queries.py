"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.llm.decontaminate import contamination
from editpulse.llm.jaccard import jaccard_join
from editpulse.llm.licenses import license_scan
from editpulse.llm.lines import line_dedup
from editpulse.llm.mixing import mix
from editpulse.llm.prefixes import conversation_trie
from editpulse.llm.quality import quality
from editpulse.llm.spelling import spelling_variants
from editpulse.llm.substrings import substring_dedup
from editpulse.llm.suffixes import suffix_dedup
from editpulse.llm.topk import exact_top_k
from editpulse.llm.toxicity import toxicity
from editpulse.llm.urls import Rule, judge_urls

ROOT = str(Path(__file__).resolve().parents[2])

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return function(spark, sf_dir)

    REGISTRY[function.__name__] = run
    return function


def importable(spark: SparkSession) -> None:
    """Let workers import this package from where the driver has it.

    For a checkout that all machines see; an installed package, or one given
    with ``--py-files``, needs nothing.
    """
    paths = spark.sparkContext.environment
    known = paths.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        paths["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, known)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op10_substring_dedup(spark, sf_dir):
    kept = substring_dedup(table(spark, sf_dir, "documents"), digest=True)
    return kept.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"), "level_words")


@query
def op1_suffix_dedup(spark, sf_dir):
    kept = suffix_dedup(table(spark, sf_dir, "documents"), digest=True)
    sha256 = F.lower(F.hex("kept")).alias("kept_sha256")
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", sha256)


@query
def op4_decontamination(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op9_source_mix(spark, sf_dir):
    mixed = mix(table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


@query
def op6_toxicity(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_jaccard_join(spark, sf_dir):
    return jaccard_join(table(spark, sf_dir, "documents"))


URL_RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


@query
def op8_url_filters(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op7_line_dedup(spark, sf_dir):
    return line_dedup(table(spark, sf_dir, "documents"))


@query
def op3_exact_top_k(spark, sf_dir):
    return exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op2_quality(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_spelling_variants(spark, sf_dir):
    return spelling_variants(table(spark, sf_dir, "documents"))


@query
def op12_conversation_trie(spark, sf_dir):
    return conversation_trie(table(spark, sf_dir, "conversations"))


@query
def op13_license_scan(spark, sf_dir):
    return license_scan(table(spark, sf_dir, "documents"))
