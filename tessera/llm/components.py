"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node that has an edge to another node; ``root`` is the smallest
    node reachable. Edges are undirected; loops, repeats and edges with a null end do not count.
    An empty table gives no rows.

    A round hooks every node's larger neighbours onto its smallest neighbour, then does the same
    for the smaller ones; a few rounds reach stars. Minima are partial aggregates and each join
    has one row per node on one side, so a hub's rows can be split over tasks. Each round is cut
    by a reliable checkpoint; only a count and a checksum reach the driver.
    """
    checkpoint_dir(edges.sparkSession)
    x, y = F.col(a), F.col(b)
    e = (edges.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v"))
         .distinct().checkpoint())
    seen = _state(e)
    while seen[0]:
        low = (e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
               .groupBy("u").agg(F.min("v").alias("m"))
               .select(F.col("u").alias("v"), F.least("u", "m").alias("m")))
        large = e.join(low, "v").select("u", F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = small.checkpoint()
        now = _state(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
