"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairwright.llm.common import cut


def _large(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung to the smallest of its neighbours and itself."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("least").alias("a"), "b").where("a <> b").distinct()


def _small(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is hung to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    hung = down.join(least, "a").select(F.col("least").alias("a"), "b").where("a <> b")
    return hung.union(least.select(F.col("least").alias("a"), F.col("a").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b) that reaches a smaller one; root is the smallest. The rest are roots.

    Each pass is two aggregations that combine before their shuffle and two plain joins with one row per node on one
    side; the links and each result are written. The passes end when the links stay the same; a check of two sums and a count tells.
    """
    state = cut(_small(cut(links.where("a <> b").select("a", "b").distinct())))
    mark = None
    while True:
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            return state.select(F.col("b").alias("node"), F.col("a").alias("root"))
        mark = tuple(now)
        state = cut(_small(_large(state)))
