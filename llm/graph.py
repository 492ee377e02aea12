"""Connected components by alternating large and small stars; every step is an aggregate and a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.shared import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """edges (a > b). Large: hang each node's larger neighbours to the least one; small: the others."""
    sides = edges.union(edges.select("b", "a")) if large else edges
    sides = sides.toDF("u", "v")
    least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = sides.join(least, "u")
    if large:
        hung = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        hung = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))
    return hung.filter("a <> b").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, root (the least node that can be reached) for every node of edges (a, b); loops are ignored.

    Edges are stored after every round, so lineage stays short and a lost executor costs one round.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    before = None
    edges = stored(edges, "edges")
    for _ in range(rounds):
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before or state[0] == 0:
            roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.union(edges.select(F.col("b"), F.col("b")).distinct())
        before = state
        edges = stored(_stars(_stars(edges, True), False), "edges")
    raise RuntimeError(f"no fixed point after {rounds} rounds")
