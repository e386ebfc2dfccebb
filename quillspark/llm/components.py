"""Connected components of an edge table, distributed.

Alternates large-star and small-star steps (each node hands its neighbours to
the smallest node it knows) until the edges no longer change; then every node
hangs on the smallest node of its component. Node minima are aggregated with
map-side combine, joins are equi-joins that adaptive execution can split, and
lineage is cut with a checkpoint every round. The number of rounds grows with
the logarithm of the longest chain. The last round is known by its edges: no
node has two roots and no root has one.
"""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.session import cut_lineage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u, v) with v < u."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                                F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
    return moved.where("u <> v").distinct()


def release(df: DataFrame) -> None:
    """Lets Spark's cleaner drop checkpoints and shuffles that nothing refers to any more (where the session allows that)."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def _settled(edges: DataFrame) -> bool:
    """Every node hangs on one root, and no root hangs on another."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))).alias("e"))
    seen = ends.groupBy("e.node").agg(F.sum("e.up").alias("roots"), F.min("e.up").alias("least"))
    return seen.where("roots > 1 or (roots = 1 and least = 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the (a, b) edges; component is its smallest node. Loops and nulls are ignored."""
    now = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not _settled(now):
        now = cut_lineage(_star(cut_lineage(_star(now, True)), False))
        release(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
