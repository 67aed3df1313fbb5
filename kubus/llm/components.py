"""Connected components of an edge table by alternating star contraction.

Every round is a group-by minimum and a join on node keys, so no task holds a
component; the number of rounds grows with the logarithm of the longest
chain.  Minima and edges are checkpointed before they are joined: both join
sides are then plain shuffles, and AQE can split the rows of a hub node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return int(row["n"]), int(row["h"] or 0)


def _minimum(edges: DataFrame) -> DataFrame:
    return materialize(edges.groupBy("u").agg(F.min("v").alias("low")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _minimum(both).select("u", F.least("u", "low").alias("low"))
    return (both.join(low, "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("low").alias("v"))
            .where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from the larger to the smaller node."""
    low = _minimum(edges)
    moved = (edges.join(low, "u").where("v <> low")
             .select(F.col("v").alias("u"), F.col("low").alias("v")))
    return moved.unionByName(low.select("u", F.col("low").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the least node.

    Loops and repeated edges do no harm; an empty table gives an empty result.
    """
    edges = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                                     F.least("u", "v").alias("v")).distinct())
    before = _state(edges)
    while before[0]:
        edges = materialize(_small_star(materialize(_large_star(edges))))
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
