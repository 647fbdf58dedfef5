"""Connected components of a graph whose nodes are hash-like values."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ponloom.operators.lineage import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): two nodes have one root if a path joins them.

    Each round every node moves to its smallest neighbour, then to where that one went, and the edges are drawn
    anew between the places reached. As nodes are hashes, their order is random, and the number of rounds grows
    with the logarithm of the longest chain. Nothing is gathered but whether edges are left.
    """
    where = F.col("a") != F.col("b")
    edges = edges.select("a", "b").filter(where)
    edges = stored(edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    placed = None
    while True:
        hook = edges.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("r"))
        then = hook.select(F.col("a").alias("r"), F.col("r").alias("s"))
        move = stored(hook.join(then, "r", "left").select("a", F.coalesce("s", "r").alias("r")), "moves")
        if placed is None:
            placed = move.select(F.col("a").alias("node"), F.col("r").alias("root"))
        else:
            onward = move.select(F.col("a").alias("root"), F.col("r").alias("to"))
            placed = placed.join(onward, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        to_b = move.select(F.col("a").alias("b"), F.col("r").alias("rb"))
        moved = edges.join(move, "a").join(to_b, "b").select(F.col("r").alias("a"), F.col("rb").alias("b"))
        edges = stored(moved.filter(where).distinct(), "edges")
        if edges.isEmpty():
            return placed
