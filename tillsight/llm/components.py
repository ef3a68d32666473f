"""Connected components of a graph given as a frame of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.shared import drop_stored, materialize


def _towards_smallest(links: DataFrame, large: bool) -> DataFrame:
    """One star step: the larger (or the smaller) neighbours of each node move to the smallest one."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        links.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    if not large:
        both = both.where("v < u")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    moved = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return moved.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of every node with a link; a component is named by its smallest node.

    ``links`` has the long columns ``a`` and ``b``.  Large-star and small-star steps alternate
    until nothing moves: O(log n) rounds in practice, each one aggregation and one equi join, and
    each written to the shared folder, where it takes the place of the one before, so a lost executor costs one round
    at most.  A hub's links
    are combined before the shuffle, and the join on it can be split by adaptive execution.
    Nothing of the graph reaches the driver but a count and a checksum.
    """
    links = materialize(
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    seen = None
    while True:
        mark = links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
        ).first()
        if tuple(mark) == seen or not mark[0]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                links.select(F.col("b"), F.col("b")).distinct()
            )
        seen = tuple(mark)
        halfway = materialize(_towards_smallest(links, True))
        moved = materialize(_towards_smallest(halfway, False))
        drop_stored(links, halfway)
        links = moved
