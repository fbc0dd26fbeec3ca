"""Connected components of a graph that is given as edges, by contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import stored


def _rank(node: Column) -> Column:
    """Order in which nodes take others in: pseudo-random, so that chains shrink by a constant factor each round."""
    return F.struct(F.xxhash64(node).alias("rank"), node.alias("node"))


def components(edges: DataFrame, path: str) -> DataFrame:
    """(node, root) for every node of the edges (a, b) that has another neighbour than itself.

    Each round maps every node to its least neighbour or itself, whichever is
    lower in rank, and renames the ends of the edges so, until none is left.
    Rounds are stored below `path`, which also cuts the lineage.  Null ends
    and edges from a node to itself are left out.
    """
    left = edges.where("a is not null and b is not null and a <> b")
    left = stored(left.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{path}/edges0")
    found: DataFrame | None = None
    k = 0
    while k == 0 or not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min(_rank(F.col("b"))).alias("least"))
        step = stored(least.select("node", F.least(F.col("least"), _rank(F.col("node")))["node"].alias("root")), f"{path}/step{k}")
        if found is None:
            found = step
        else:
            after = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
            found = stored(found.join(after, "root", "left").select("node", F.coalesce("next", "root").alias("root")), f"{path}/found{k}")
        ends = left.join(step.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a").join(step.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
        k += 1
        left = stored(ends.where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), f"{path}/edges{k}")
    return found
