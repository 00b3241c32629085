"""Connected components of an edge table by alternating star contraction
(Kiveris et al. 2014): joins and aggregates only, nothing on the driver but one
count per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import staged


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of an edge, ``root`` the smallest node of its
    component. Edges may repeat, point either way or be loops; an empty table gives
    an empty result.

    Each round points a node's larger neighbours at its smallest one, then a node's
    smaller neighbours too. A star of any size costs a partial minimum per task and
    a join whose repeated side AQE can split; rounds grow with the logarithm of the
    longest path. The edges of a round are written out, so no lineage builds up."""
    cur = staged(
        edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
        "cc_edges",
    )
    seen = None
    for _ in range(max_rounds):
        state = cur.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen or state[0] == 0:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                cur.select(F.col("v").alias("node"), F.col("v").alias("root"))
            ).distinct()
        seen = state
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # every edge (larger u, smaller v): u is a larger neighbour of v
        large = (
            cur.select(F.col("v").alias("u"), F.col("u").alias("far")).join(low, "u")
            .select(F.col("far").alias("u"), F.col("m").alias("v")).distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v"))).distinct()
        )
        cur = staged(small, "cc_edges")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
