"""License scans by a positional index of rare words, in DataFrame operations only.

A template is a passage of a license with a mandatory key phrase. Texts are cut
into words once; what is kept are the places of template words, a small part of
all words. Of each template whose key words a text has, the rarest of these
(by document frequency over all texts) are looked up: a word at place p that is
the q-th of the template votes for a passage that begins at p - q. Passages on
which the rare words agree are verified on the whole key phrase; the share of
the template's words that stand where they should is the score.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.llm import exchange

RARE = 2  # words of a key phrase that are looked up
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
END = "."  # no word: stands behind the last one, so that its place is their number


@dataclass(frozen=True)
class Template:
    """``words`` of a passage; those from ``key`` up to ``key_end`` must all be there."""

    label: str
    words: str
    key: int = 0
    key_end: int | None = None
    base: bool = False

    def rows(self, number: int):
        words = self.words.split()
        end = len(words) if self.key_end is None else self.key_end
        for place, word in enumerate(words):
            yield (number, self.label, self.base, word, place, self.key <= place < end)


# Names and opening passages of common licenses.
BASE = (
    Template("mit", "mit license", base=True),
    Template("apache", "apache license", base=True),
    Template("gpl", "general public license", base=True),
)
PASSAGES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", 0, 6),
    Template("mit", "released under the mit license", 0, 5),
    Template("apache", "licensed under the apache license version 2 0", 0, 5),
    Template("gpl", "redistribute it and or modify it under the terms of the gnu general public license", 8, 15),
    Template("gpl", "gnu general public license as published by the free software foundation", 0, 4),
    Template("lgpl", "gnu lesser general public license as published by the free software foundation", 1, 5),
    Template("agpl", "gnu affero general public license as published by the free software foundation", 1, 5),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", 0, 8),
    Template("mpl", "subject to the terms of the mozilla public license", 6, 9),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose", 0, 5),
    Template("unlicense", "this is free and unencumbered software released into the public domain", 2, 6),
    Template("cc", "licensed under a creative commons attribution", 3, 6),
)
TEMPLATES = BASE + PASSAGES


def index_of(spark: SparkSession, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(template, label, base, word, place, key) of every word of every template."""
    rows = [row for number, template in enumerate(templates) for row in template.rows(number)]
    return spark.createDataFrame(rows, "template int, label string, base boolean, word string, place int, key boolean")


def places(docs: DataFrame, vocabulary: list[str], id_col: str, text_col: str) -> DataFrame:
    """(row, id, place, word) of the words of ``vocabulary``, and ``END`` behind the last word.

    ``row`` tells rows apart, equal ones too; as it may differ from run to run,
    the caller stores the result before he uses it twice.
    """
    words = F.regexp_extract_all(F.coalesce(text_col, F.lit("")), F.lit(WORD), F.lit(0))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.concat(words, F.array(F.lit(END))).alias("words"),
    )
    rows = rows.select("row", "id", F.posexplode("words").alias("place", "word"))
    rows = rows.withColumn("lower", F.lower("word")).filter(F.col("lower").isin([*vocabulary, END]))
    # Lower-casing of other letters can end in A-Z: only A-Z themselves count.
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    rows = rows.filter(F.translate("word", upper, lower) == F.col("lower"))
    return rows.select("row", "id", "place", F.col("lower").alias("word"))


def _rarest(found: DataFrame, index: DataFrame, texts: int) -> DataFrame:
    """(row, template, word, looked) : the rarest key words of templates whose key words a text has.

    At most one row for each text and word of a template, whatever the texts hold.
    """
    in_text = found.filter(F.col("word") != END).groupBy("row", "word").agg(F.lit(1).alias("one")).drop("one")
    df = in_text.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    keys = index.filter("key").groupBy("template", "word").agg(F.lit(1).alias("one")).drop("one")
    idf = F.log((F.lit(texts) + 1) / (F.col("df") + 1))
    keys = keys.join(F.broadcast(df), "word").withColumn("idf", idf)
    # Ranked among the template's words: a text that has all of them has the rarest.
    ranked = keys.groupBy("template").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("idf")).alias("rank"), "word"))).alias("words")
    )
    needed = index.filter("key").groupBy("template").agg(F.countDistinct("word").alias("needed"))
    ranked = ranked.join(needed, "template").filter(F.size("words") == F.col("needed"))
    rare = ranked.select("template", "needed", F.explode(F.slice("words", 1, RARE)).alias("w"))
    rare = rare.groupBy("template", "needed").agg(F.collect_list("w.word").alias("rare"))
    has = in_text.join(F.broadcast(keys.select("word", "template")), "word")
    has = has.groupBy("row", "template").agg(F.count(F.lit(1)).alias("has"))
    has = has.join(F.broadcast(rare), "template").filter(F.col("has") == F.col("needed"))
    return has.select("row", "template", F.size("rare").alias("looked"), F.explode("rare").alias("word"))


def passages(found: DataFrame, index: DataFrame, texts: int) -> DataFrame:
    """(row, template, label, base, start, score) of every passage with its whole key phrase.

    ``found`` is what ``places`` gives, stored. ``score`` is the share of the
    template's words at their place. A passage is known by its text, template
    and start, so no text's places meet in one group.
    """
    rare = _rarest(found, index, texts)
    length = index.groupBy("template", "label", "base").agg(
        F.count(F.lit(1)).alias("length"), F.sum(F.col("key").cast("int")).alias("key_length")
    )
    at = F.broadcast(index.select("template", "word", F.col("place").alias("nth"), "key"))
    votes = found.join(rare, ["row", "word"]).join(at.filter("key"), ["template", "word"])
    votes = votes.withColumn("start", F.col("place") - F.col("nth"))
    agreed = votes.groupBy("row", "template", "start").agg(
        F.count_distinct("word").alias("agree"), F.first("looked").alias("looked")
    )
    agreed = agreed.filter(F.col("agree") == F.col("looked")).select("row", "template", "start")
    wanted = agreed.join(at, "template").withColumn("place", F.col("start") + F.col("nth"))
    stands = wanted.join(found.select("row", "place", "word"), ["row", "place", "word"])
    matched = stands.groupBy("row", "template", "start").agg(
        F.count(F.lit(1)).alias("matched"), F.sum(F.col("key").cast("int")).alias("key_matched")
    )
    whole = matched.join(F.broadcast(length), "template").filter(F.col("key_matched") == F.col("key_length"))
    return whole.select("row", "template", "label", "base", "start", (F.col("matched") / F.col("length")).alias("score"))


def _labels(condition: Column) -> Column:
    return F.array_join(F.array_sort(F.collect_set(F.when(condition, F.col("label")))), ",")


def license_scan(
    docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row for each row of ``docs``: words, base places, labels and score.

    Words are runs of letters, digits and characters beyond ASCII, with A-Z
    lower-cased. ``n_base`` counts all places of base templates, ``first_word``
    and ``last_word`` are the least and the largest of them, null without any.
    ``base_labels`` are theirs, ``labels`` those of all templates whose key
    phrase stands in the text; both are empty texts without any. ``score`` is
    the best share of a template found, 0 without any. A null text has no words;
    rows of a null or repeated id and equal rows are judged each by itself; other
    columns are ignored. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    vocabulary = sorted({word for template in templates for word in template.words.split()})
    index = index_of(spark, templates)
    found = exchange.stored(places(docs, vocabulary, id_col, text_col), "license-places")
    ends = found.filter(F.col("word") == END)
    passage = passages(found, index, ends.count())
    base = F.when(F.col("base"), F.col("start"))
    by_row = passage.groupBy("row").agg(
        F.count(base).alias("n_base"),
        F.min(base).alias("first_word"),
        F.max(base).alias("last_word"),
        _labels(F.col("base")).alias("base_labels"),
        _labels(F.lit(True)).alias("labels"),
        F.max("score").alias("score"),
    )
    rows = ends.join(by_row, "row", "left")
    return rows.select(
        F.col("id").alias(id_col),
        F.col("place").cast("long").alias("n_words"),
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
