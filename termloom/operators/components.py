"""Connected components of an edge table by alternating large-star and small-star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.operators.lineage import stage, unstage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction: every node hands its larger (or not larger) neighbours to its smallest neighbour."""
    if large:
        nbr = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        nbr = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = nbr.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
    got = nbr.join(low, "u")
    if large:
        out = got.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = got.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
    return out.where("u <> v")


def _settled(edges: DataFrame) -> bool:
    """Whether the distinct edges (u > v) are stars already: every u has one v, and no v is a u."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up")))
    role = ends.groupBy("node").agg(F.sum("up").alias("n"), F.min("up").alias("low"))
    return role.where("n > 1 or (n = 1 and low = 0)").isEmpty()


def components(edges: DataFrame, src: str = "u", dst: str = "v", max_rounds: int = 60) -> DataFrame:
    """(node, component): component is the smallest node reachable over undirected edges.

    Nodes are of any ordered type. Null ends and self loops are ignored; a node without an edge gets no row. Each
    round halves distances at least, so rounds grow with the logarithm of the longest path; edges that are stars need
    none. Nothing is collected but a flag; a node with very many neighbours is met by partial aggregation and a join
    that AQE can split.
    """
    e = stage(
        edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
        .where(F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col(src) != F.col(dst)))
        .distinct(),
        "edges",
    )
    rounds = 0
    while not _settled(e):
        if rounds == max_rounds:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        before, e = e, stage(_star(_star(e, True), False).distinct(), "edges")
        unstage(before)
        rounds += 1
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
