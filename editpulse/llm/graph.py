"""Connected components of stored edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.llm import exchange


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its least node) for all nodes of ``edges`` (a, b).

    Every round each node points to its least neighbour, pointers are followed
    once more, and edges are drawn anew between what they lead to. A node that
    is not the least around it goes, so the rounds are about as many as the
    logarithm of the longest path. Rounds are stored, nothing is collected.
    """
    edges = exchange.stored(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    labels = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = labels.withColumn("component", F.col("node"))
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("to"))
        least = exchange.stored(least, "pointers")
        onward = least.select(F.col("a").alias("to"), F.col("to").alias("further"))
        pointers = least.join(onward, "to").select(F.col("a").alias("from"), F.col("further").alias("to"))
        pointers = exchange.stored(pointers, "pointers")
        moved = labels.join(pointers, F.col("component") == F.col("from"), "left")
        labels = exchange.stored(moved.select("node", F.coalesce("to", "component").alias("component")), "labels")
        first = pointers.select(F.col("from").alias("a"), F.col("to").alias("x"))
        second = pointers.select(F.col("from").alias("b"), F.col("to").alias("y"))
        drawn = edges.join(first, "a").join(second, "b").filter("x <> y")
        drawn = drawn.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        edges = exchange.stored(drawn, "edges")
    return labels
