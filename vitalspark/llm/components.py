"""Connected components of an edge table by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalspark.session import materialize


def components(edges: DataFrame, label: str = "components", rounds: int | None = None, ready: bool = False) -> DataFrame:
    """node, component (its smallest node) of every node in ``edges`` (a, b).
    With ``rounds``, stop after so many: then equal labels still mean connected
    nodes, but a long chain may have several labels.  Edges that are ``ready``
    (written, a < b) are read as they are.

    Every round hangs each node's neighbours on the smallest of them, first the
    larger ones, then the smaller ones; the rounds end when every node hangs on
    one other that hangs on none, after about the logarithm of the longest chain.
    Each round is written, so a lost executor costs no more than one round; at
    most one row a round comes to the driver."""
    tree = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    if not ready:
        tree = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(),
                           label)
    done = 0
    while True:
        both = tree.unionByName(tree.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.col("node")).alias("low"))
        large = (both.where("v > u").join(low, both.u == low.node)
                 .select(F.col("v").alias("u"), F.col("low").alias("v"))
                 .unionByName(low.where("low < node").select(F.col("node").alias("u"), F.col("low").alias("v")))
                 .distinct())
        large = materialize(large, label)
        least = large.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("low"))
        small = (large.join(least, large.u == least.node).where("v <> low")
                 .select(F.col("v").alias("u"), F.col("low").alias("v"))
                 .unionByName(least.select(F.col("node").alias("u"), F.col("low").alias("v")))
                 .distinct())
        tree = materialize(small, label)
        done += 1
        if done == rounds:
            break
        ends = tree.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            tree.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        if ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1 AND up > 0").isEmpty():
            break
    every = tree.select(F.col("u").alias("node"), "v").unionByName(tree.select(F.col("v").alias("node"), "v"))
    return every.groupBy("node").agg(F.min("v").alias("component"))
