"""Connected components of a stored edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.session import checkpointed


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Each vertex joins its neighbours to the least of its neighbourhood: the
    larger ones (of all neighbours), or the smaller ones and itself."""
    if larger:
        near = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("w"))
    least = least.select("u", F.least("u", "w").alias("m"))
    if larger:  # stored, so that the join has two plain shuffles and a hub can be split
        least = checkpointed(least)
    hung = near.join(least, "u")
    if larger:
        out = hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    return out.where("u != v").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(v, root) for every vertex of ``edges`` (u, v: longs); the root is the least vertex.

    Each round reduces by vertex before it joins, and is cut off by a reliable
    checkpoint.  The rounds end when a round changes no edge.
    """
    edges = checkpointed(edges.where("u != v").distinct())
    state = None
    for _ in range(rounds):
        edges = checkpointed(_stars(_stars(edges, True), False))
        row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if (row.n, row.x) == state:
            break
        state = (row.n, row.x)
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("u").alias("v"), F.col("v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("v"), "root").distinct())
