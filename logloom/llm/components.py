"""Connected components of a graph as rounds of joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.plans.scratch import saved


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, component (smallest node reachable) for every node of ``edges`` (a, b: long).

    Alternates large-star and small-star steps: each node's larger, then smaller neighbours are linked to its smallest one, until all
    edges lead to the smallest node of their component. Needs a number of rounds that grows with the logarithm of the
    longest chain. Each step is a window-free aggregation and a join on the node; results of a round are written.
    """
    current = saved(_oriented(edges), "components")
    before = None
    for _ in range(most_rounds):
        large = _star(current.select("a", "b").unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b"))), larger=True)
        current = saved(_star(_oriented(large), larger=False), "components")
        now = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"no end after {most_rounds} rounds")
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionByName(roots)


def _oriented(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller node."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Neighbours of each node, linked to the smallest of itself and them.

    ``edges`` has a row (node, neighbour); with ``larger`` only neighbours above the node are linked, else the node is
    linked as well (its neighbours then all lie below it).
    """
    least = edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("_least"))
    joined = edges.join(least, "a")
    if larger:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("_least").alias("b"))
    linked = joined.where("b <> _least").select(F.col("b").alias("a"), F.col("_least").alias("b"))
    return linked.unionByName(least.where("a <> _least").select("a", F.col("_least").alias("b"))).distinct()
