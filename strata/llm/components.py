"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b) but the roots: root is the smallest reachable node.

    Alternates large-star and small-star steps: every round hangs neighbours on the smallest one
    they know, so the rounds grow with the logarithm of a component's size, and no step gathers a
    node's neighbours in one row. Each round is written to the shared folder.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not is_forest_of_stars(now):
        now = written(small_star(large_star(now)), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether each node hangs on one other at most, and none hangs on one that hangs itself."""
    both = edges.select(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionAll(
        edges.select(F.col("b"), F.lit(0), F.lit(1))
    )
    roles = both.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return roles.where("hangs > 1 OR hangs = 1 AND holds = 1").isEmpty()


def large_star(edges: DataFrame) -> DataFrame:
    """Each node hangs its larger neighbours on the smallest of itself and its neighbours."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (
        both.where("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .where("a <> b")
        .distinct()
    )


def small_star(edges: DataFrame) -> DataFrame:
    """Each node hangs itself and its smaller neighbours on the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()
