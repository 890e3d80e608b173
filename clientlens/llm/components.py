"""Connected components of an edge table by alternating large-star and
small-star steps (MapReduce-style; every step is a grouped minimum and an
equi-join, so a node with very many neighbours is pre-aggregated and its join
can be split)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientlens.llm.common import cut


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Tie neighbours of each node u to the least of u and its neighbours:
    the greater ones (large star) or the smaller ones and u (small star)."""
    if large:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        moved = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = pairs.groupBy("a").agg(F.min("b").alias("m"))
        moved = (pairs.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))))
    return moved.where("a > b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long, null-free, any order, repeats and self-loops
    allowed) -> (node, root): each node that has an edge to another node with
    the least node reachable. No edges: no rows.

    Each round is checkpointed (lost executors read it again); rounds grow
    with the logarithm of the longest chain.
    """
    pairs = cut(edges.where("a <> b")
                .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        state = pairs.agg(F.count("*").alias("n"),
                          F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state.n == 0 or state == seen:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
        pairs = cut(_star(_star(pairs, large=True), large=False))
