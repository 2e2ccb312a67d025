"""Connected components by alternating large-star and small-star steps, all in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mosaica.operators.lineage import cut

MAX_ROUNDS = 60


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge list; root is the smallest node that can be reached.

    Nulls and loops are ignored, repeated edges count once, no edges give no rows. Each round costs two
    joins on node keys whose small side has one row a node, so a hub's edges can be split; the number of rounds
    grows with the logarithm of the longest path. Rounds are cut by checkpoints.
    """
    e = (
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where("u is not null and v is not null and u <> v and "
               f"{a} is not null and {b} is not null")
        .distinct()
    )
    e = cut(e)
    seen = None
    for _ in range(MAX_ROUNDS):
        state = _state(e)
        if state == seen or state[0] == 0:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        seen = state
        e = cut(_small_star(_large_star(e)))
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()
