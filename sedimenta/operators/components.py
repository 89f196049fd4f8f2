"""Connected components by parallel hooking and shortcutting over a parent table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str, max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node of each component of the graph of edges (a, b).

    The parent array is a table. A round hooks, for every edge, the parents of
    both ends onto the smaller grandparent found on either side (so trees merge
    even where an edge joins two inner nodes), then shortcuts every node to its
    grandparent. The number of rounds grows with the logarithm of the longest
    path. Each round is three equi-joins and one aggregation, pre-aggregated
    before its shuffle: a node with very many edges sends one row per task. The
    table is written each round, which cuts lineage; the driver sees one count.

    Defined results: edges with a null end are left out, loops keep their node,
    repeated edges count once, no edges give an empty table.
    """
    kind = edges.select(F.col(edges.columns[0]).alias("a"), F.col(edges.columns[1]).alias("b")).where("a is not null and b is not null")
    edge = scratch.write(kind.distinct(), f"{name}-edges")
    parent = edge.select(F.explode(F.array("a", "b")).alias("node"), F.least("a", "b").alias("root")).groupBy("node").agg(F.min("root").alias("root"))
    parent = scratch.write(parent, f"{name}-0")
    for round_ in range(1, max_rounds + 1):
        up = parent.select(F.col("node").alias("p"), F.col("root").alias("grand"))
        full = parent.join(up, F.col("root") == F.col("p")).select("node", "root", "grand")
        ends = edge.join(full.select(F.col("node").alias("a"), F.col("root").alias("pa"), F.col("grand").alias("ga")), "a").join(full.select(F.col("node").alias("b"), F.col("root").alias("pb"), F.col("grand").alias("gb")), "b")
        low = F.least("ga", "gb")
        # what each edge tells: its two ends and both their parents may go down to `low`
        hooks = ends.where((F.col("ga") != F.col("gb")) | (F.col("pa") != low) | (F.col("pb") != low)).select(F.explode(F.array("a", "b", "pa", "pb")).alias("node"), low.alias("root"))
        best = full.select("node", F.col("grand").alias("root")).unionByName(hooks).groupBy("node").agg(F.min("root").alias("root"))
        after = scratch.write(best, f"{name}-{round_}")
        moved = after.join(parent.select("node", F.col("root").alias("was")), "node").where("root <> was").limit(1).count()
        if round_ > 1:
            scratch.drop(f"{name}-{round_ - 2}")
        parent = after
        if not moved:
            return parent
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
