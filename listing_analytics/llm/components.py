"""Connected components of an undirected graph by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from listing_analytics.staging import stage


def _star(pairs: DataFrame) -> DataFrame:
    """Each `u` with its least neighbour or itself, joined back to its neighbours: `u, v, least`.

    The least neighbours are combined before the shuffle and joined, not collected, so a hub is split like any hot key.
    """
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least"))
    return pairs.join(least, "u")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """`node, component` for each node of an edge: component is the least node that can be reached.

    Every round is written to the shared folder. Edges from a node to itself, repeated and null ones do no harm; no edges,
    no rows. The number of rounds grows with the logarithm of the longest path.
    """
    pairs = stage(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct(),
        "edges",
    )
    state = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        small = _star(large)
        pairs = stage(
            small.select(F.greatest("v", "least").alias("u"), F.least("v", "least").alias("v"))
            .unionByName(small.select("u", F.col("least").alias("v")))
            .where("u <> v").distinct(),
            "edges",
        )
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    roots = pairs.select(F.col("v").alias("node")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
