"""Connected components of an edge table by alternating stars, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineage_spark.llm.common import one_task_if_small, written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    rest = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the least node) for every node of ``edges`` (``u, v``, long) other than the least ones.

    A component's least node has no row of its own. Every round leaves a checkpoint; rounds grow with the
    logarithm of the longest path, and a hot node costs one row per edge, never a list.
    """
    # loops of joins over few edges are one task, not a shuffle each
    narrow = lambda df: one_task_if_small(df, 16)
    state = narrow(written(_small_star(narrow(written(edges, "links"))), "components"))
    # done when every component is a star: no node is both a member and a centre
    while not state.select(F.col("v").alias("u")).join(state.select("u"), "u", "left_semi").isEmpty() or _split(state):
        state = narrow(written(_small_star(_large_star(state)), "components"))
    return state.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _split(state: DataFrame) -> bool:
    """True if some member still has two centres."""
    return not state.groupBy("u").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).where("lo <> hi").isEmpty()
