"""Connected components of an edge list by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import written


def _star(edges: DataFrame, large: bool, step: str) -> DataFrame:
    """One star step on (a, b) edges.

    The least neighbour of a node is an aggregate with map-side combine; it is written before the join, so that
    both sides of the join are plain exchanges, which adaptive execution splits where a hub has many neighbours.
    """
    if large:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")),
        f"least-{step}")
    joined = both.join(least.hint("merge"), "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a",
            F.col("m").alias("b")))
    return written(out.where("a <> b").distinct(), f"edges-{step}")


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars: each node hangs below one other, and none that hangs has others below it."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("up"),
        F.lit(0).alias("down")).union(edges.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("v").agg(F.sum("up").alias("up"),
        F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the undirected (a, b) edges; root is the least node reachable.

    Empty edges give an empty table.  Self-links are ignored.  Each step is written, so that a lost executor costs
    one step.  The loop ends when the edges are stars around their least nodes.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
        F.least("a", "b").alias("b")).distinct(), "edges")
    for k in range(rounds):
        if _settled(edges):
            break
        edges = _star(_star(edges, True, f"{k}l"), False, f"{k}s")
    else:
        raise RuntimeError("the components did not settle")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return written(nodes.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct(), "roots")
