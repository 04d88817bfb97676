"""Connected components by alternating large-star and small-star steps.

Every step makes each node point to a smaller one; all of it is joins and aggregations, and each
round is a stored table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmart.llm.common import written


# A node may have a large part of all edges: its edges are joined in this many parts.
PARTS = 8


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """``edges`` with ``least`` of their node ``a``."""
    dealt = edges.withColumn("part", F.pmod(F.xxhash64("b"), F.lit(PARTS)))
    every = least.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))))
    return dealt.join(every, ["a", "part"]).drop("part")


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node point to its least neighbour or itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return _with_least(both.filter("b > a"), least).select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of every node, and the node itself, point to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = _with_least(edges, least).select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).filter("a <> b").distinct()


def _print_of(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (``a``, ``b``: long): the least node of its component."""
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    current = written(ordered, "edges")
    before = _print_of(current)
    while before[0]:
        current = written(_small_star(_large_star(current)), "edges")
        after = _print_of(current)
        if after == before:
            break
        before = after
    labels = current.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.unionByName(labels.select(F.col("label").alias("node"), "label").distinct())
