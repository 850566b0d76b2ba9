"""Connected components of a graph given as edges, without ever gathering a node's neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.session import written

#: Rounds after which something must be wrong: each round shortens paths by a constant factor.
ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the node's smallest one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    return both.filter("b > a").join(least.hint("shuffle_merge"), "a").select(F.col("least").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them. Edges have ``a < b``."""
    least = edges.groupBy("b").agg(F.min("a").alias("least"))
    moved = edges.join(least.hint("shuffle_merge"), "b").filter("a <> least").select(F.col("least").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(least.select(F.col("least").alias("a"), "b")).distinct()


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for all nodes of edges ``a < b``.

    Alternating large-star and small-star steps (Kiveris et al., 2014). A node's neighbours are only
    reduced to their minimum, which is pre-aggregated, and the joins have one row per node on one side. Every
    round is written to the shared folder.
    """
    stars = written(edges)
    before = None
    for _ in range(ROUNDS):
        stars = written(_small_star(_large_star(stars)))
        state = stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("decimal(20,0)"))).first()
        if state == before:
            return stars.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
                stars.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
            )
        before = state
    raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
