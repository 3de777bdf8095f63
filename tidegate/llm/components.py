"""Connected components of a large edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.session import materialise


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(node, component)``: the smallest node reachable from each node that has an edge.

    ``edges`` has two bigint columns ``a`` and ``b``; self loops and repeated edges do no harm,
    edges with a null end are ignored. Large-star and small-star steps alternate: each node hands
    its neighbours to the smallest one known, first to those above it, then to those below. The
    edge table never grows, every step is a partial aggregate and a join, and a hub's edges can be
    split between tasks because a node's neighbours are never gathered. Each round is written to
    the shared folder, so a lost executor costs one round at most. The table stands still after a
    number of rounds that grows with the logarithm of the longest path.
    """
    links = (
        edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    links = materialise(links, label)
    state = _fingerprint(links)
    while True:
        links = materialise(_small_star(_large_star(links)), label)
        new = _fingerprint(links)
        if new == state:
            break
        state = new
    # Now every edge leads from a node to the smallest of its component.
    roots = links.select("v").distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("component"))
    )


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (
        both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    ).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    lowest = links.groupBy("u").agg(F.min("v").alias("m"))
    joined = links.join(lowest, "u")
    moved = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    kept = lowest.select("u", F.col("m").alias("v"))
    return moved.unionByName(kept).distinct()


def _fingerprint(links: DataFrame) -> tuple:
    """Size and two order-free sums of an edge table; equal tables have equal ones."""
    row = links.agg(
        F.count(F.lit(1)),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
        F.sum(F.xxhash64("v", "u", F.lit(1)).cast("decimal(38,0)")),
    ).first()
    return tuple(row)
