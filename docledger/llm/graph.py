"""Connected components by alternating large-star and small-star steps; a hub's edges are never gathered in one group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, release


def components(edges: DataFrame, most: int = 40) -> DataFrame:
    """edges: u, v (long). One row per node that has an edge to another: node, root (the smallest node it reaches).

    The smallest neighbours are written before they meet the edges, so that the join can split a hub's edges.
    """
    now = cut(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(now)
    for _ in range(most):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = cut(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        release(now, least)
        least = cut(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        low = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut(low.unionByName(least.withColumnRenamed("m", "v")).distinct(), "small-star")
        release(large, least)
        before, state = state, _state(now)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
