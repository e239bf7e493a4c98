"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import settle


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """One step over (a, b) links: every node's neighbours on one side of it go to the least node around it."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("low"))
    moved = both.join(least, both["a"] == least["node"])
    if large:
        moved = moved.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        moved = moved.select("b", "low").union(least.select("node", "low")).toDF("a", "b")
    return moved.filter("a <> b").distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of each node of the links (a, b); the component is its least node.

    Nodes without links do not appear. Needs a number of rounds that grows with the logarithm of the
    number of nodes; more than ``rounds`` is an error. Links of a node to itself and repeated links change nothing.
    """
    now = settle(links.select("a", "b").filter("a <> b").distinct())
    state = None
    for _ in range(rounds):
        nxt = settle(_stars(settle(_stars(now, large=True)), large=False))
        new = nxt.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == new:
            return nxt.select(F.col("a").alias("node"), F.col("b").alias("component")).union(nxt.select("b", "b").distinct())
        state, now = new, nxt
    raise RuntimeError(f"components did not settle in {rounds} rounds")
