"""Connected components of an edge table by alternating large and small stars.

Each round is two joins and two groupings with partial minima; rounds are stored in the shared folder, so no
lineage grows and no node set reaches the driver. Rounds needed grow with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest member of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u")
    return (
        linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
        .where("u <> v")
        .distinct()
    )


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node that ``edges`` (u, v: long) names; root is the smallest node it can reach.

    Loops and repeated edges do no harm, null ends are no edges; an empty table gives an empty table.
    """
    now = stored(edges.select("u", "v").where("u <> v").distinct(), "edges")
    if now.isEmpty():
        return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    state = None
    for _ in range(rounds):
        now = stored(_small_star(_large_star(now)), "edges")
        seen = now.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")
        ).first()
        if seen == state:
            break
        state = seen
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
