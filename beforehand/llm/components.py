"""Connected components by alternating large and small stars, a written table a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _star(edges: DataFrame, label: str, small: bool) -> DataFrame:
    """Larger neighbours (or, small, all smaller ones and the node) moved to the least one."""
    back = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    ahead = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    near = back if small else back.unionByName(ahead)
    # written: with plain shuffles on both sides, a centre that holds most edges is split
    least = near.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
    least = saved(least.withColumn("m", F.least("c", "m")), label)
    moved = near.join(least, near["u"] == least["c"])
    if small:
        out = moved.select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(
            least.select(F.col("m").alias("a"), F.col("c").alias("b"))
        )
    else:
        out = moved.where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return out.where("a < b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the least node of it) of undirected ``a, b``; edges are distinct longs.

    Kiveris et al., "Connected components in MapReduce and beyond" (2014): the number of edges
    never grows and rounds follow the logarithm of the size of a component. When nothing
    changes, every node hangs on the least one.
    """
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = saved(edges.where("a < b").distinct(), "edges")
    state = _state(edges)
    while state[0]:
        large = saved(_star(edges, "star", False), "edges")
        edges = saved(_star(large, "star", True), "edges")
        last, state = state, _state(edges)
        if state == last:
            break
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(roots)
