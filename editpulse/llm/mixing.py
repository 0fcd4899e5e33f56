"""Mixing sources to target weights by Pareto order sampling.

A source's target over its size is how often each of its documents is wanted.
The whole part of that number is given to every document for certain. For the
rest the documents are ranked by random odds over inclusion odds,
``u / (1 - u) : p / (1 - p)``, and taken from the top until the words that are
missing to the target are there. The random number is a hash of the document,
so reruns agree.

No source is sorted in one task: its words are summed by 4096 slices of the
rank's range, the sums give the slice in which the cut falls, and only that
slice is sorted to find the last document taken. What is known of a source (its
target and its cut) is one row, and the texts are only read, never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editpulse.llm import exchange

SLICES = 4096
_WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Runs of other than space and the control bytes 9 to 13; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORDS)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """``target`` words of each source; ``sizes`` has a row per source.

    All sizes together are shared by weight. No source gets more than ``most``
    times its size; the excess goes to the others by weight until none is above.
    In order of limit per weight, the first source whose share stays within its
    limit, when all before it are at theirs, sets the share of all from it on.
    """
    ratio = F.col("limit") / F.col("weight")
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    up = Window.orderBy(ratio, F.col("source").asc_nulls_last())
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    rest = up.rowsBetween(0, Window.unboundedFollowing)
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), turn)
    rows = sizes.withColumn("weight", weight).withColumn("limit", F.col("source_size") * float(most))
    left = F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    rows = rows.withColumn("share", left / F.sum("weight").over(rest)).withColumn("place", F.row_number().over(up))
    free = F.col("share") * F.col("weight") <= F.col("limit")
    first = F.min(F.when(free, F.struct("place", "share"))).over(Window.partitionBy())
    target = F.least(F.col("limit"), first["share"] * F.col("weight"))
    return rows.withColumn("target", target).select("source", "source_size", "target")


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    most: float = 3.0,
    source_col: str = "source",
    text_col: str = "text",
    id_col: str = "doc_id",
    seed: str = "mix",
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies`` of each row.

    Sources in order of code points, null last, take the ``weights`` in turn. The
    size of a document is its number of words, 0 for a null or empty text, which
    is drawn like any other. Ties of the rank go by id, null first, size and
    hash; rows that agree in all of these are taken together. A source without
    words gets nothing, an empty table gives an empty one. The added columns
    replace those of the same names, other columns stay.
    """
    added = ("size", "source_size", "target", "copies")
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(docs.columns)]).alias("row"),
        F.col(source_col).alias("source"),
        F.col(id_col).cast("string").alias("id"),
        word_count(F.col(text_col)).alias("size"),
        F.md5(F.concat_ws("|", F.lit(seed), F.col(id_col).cast("string"), F.md5(text_col))).alias("print"),
    )
    slim = exchange.stored(rows.drop("row"), "mix-sizes")
    wanted = targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    wanted = exchange.stored(wanted, "mix-targets")
    cuts = exchange.stored(_cuts(_ranked(slim, wanted)), "mix-cuts")
    cuts = cuts.withColumnRenamed("source", "of")
    drawn = _ranked(rows, wanted)
    drawn = drawn.join(cuts, drawn["source"].eqNullSafe(cuts["of"]), "left")
    more = (F.col("slice") < F.col("cut")) | ((F.col("slice") == F.col("cut")) & (_key() <= F.col("last")))
    copies = (F.col("whole") + F.coalesce(more.cast("int"), F.lit(0))).cast("int")
    return drawn.withColumn("copies", copies).select(
        *[F.col(f"row.c{i}").alias(name) for i, name in enumerate(docs.columns) if name not in added], *added
    )


def _key() -> Column:
    return F.struct("rank", "id", "size", "print")


def _ranked(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Every row with its source's target, whole copies, and its rank for one more."""
    wanted = wanted.withColumnRenamed("source", "of")
    rows = rows.join(wanted, rows["source"].eqNullSafe(wanted["of"])).drop("of")
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = rows.withColumn("whole", F.floor(times)).withColumn("odds", times - F.floor(times))
    # 52 bits of the hash, halfway between steps: never 0 and never 1.
    u = (F.conv(F.substring("print", 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    rank = (u / (1 - u)) / (F.col("odds") / (1 - F.col("odds")))
    rows = rows.withColumn("rank", F.when(F.col("odds") > 0, rank))
    # Cuts fall near rank 1, where these slices are narrowest.
    return rows.withColumn("slice", F.floor(F.col("rank") / (1 + F.col("rank")) * SLICES))


def _cuts(rows: DataFrame) -> DataFrame:
    """For each source the slice of the cut, and the last document taken in it."""
    rows = rows.filter(F.col("slice").isNotNull())
    missing = F.first("target") - F.first("source_size") * F.first("whole")
    sums = rows.groupBy("source", "slice").agg(F.sum("size").alias("words"), missing.alias("missing"))
    so_far = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("words").over(so_far), F.lit(0))
    at = sums.withColumn("missing", F.col("missing") - before).filter(F.col("missing") >= 0)
    at = at.groupBy(F.col("source").alias("of")).agg(F.max(F.struct("slice", "missing")).alias("at"))
    at = at.select("of", F.col("at.slice").alias("cut"), F.col("at.missing").alias("missing"))
    at = exchange.stored(at, "mix-slices")
    inner = rows.join(at, rows["source"].eqNullSafe(at["of"]) & (rows["slice"] == at["cut"]))
    order = Window.partitionBy("source").orderBy("rank", "id", "size", "print")
    upto = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    # The document at the cut is taken if that comes nearer to the target.
    inner = inner.withColumn("taken", upto - F.col("size") / 2 <= F.col("missing"))
    last = F.max(F.when(F.col("taken"), _key())).alias("last")
    return inner.groupBy("source").agg(F.first("cut").alias("cut"), last)
