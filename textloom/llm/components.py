"""Connected components of an edge table, by alternating large-star and small-star steps (Kiveris et al., 2014).

Edges stay distributed. A step is a minimum per node, which combines before the shuffle, and a join of the edges with one
row for each node; where a hub has so many edges that its partition is skewed, adaptive execution splits the edges' side.
Each round is checkpointed to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import checkpoint


def _lowest(directed: DataFrame) -> DataFrame:
    return directed.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_lowest(both), "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _lowest(down)
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, u: str = "u", v: str = "v", rounds: int = 64) -> DataFrame:
    """(node, component) of every node with an edge; component is the smallest node reachable. Nodes are bigints."""
    now = checkpoint(edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u is not null and v is not null and u <> v").distinct())
    before = None
    for _ in range(rounds):
        now = checkpoint(_small_star(_large_star(now)))
        state = tuple(now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = state
    raise RuntimeError(f"components did not settle in {rounds} rounds")
