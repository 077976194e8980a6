"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b): the
    smallest node reachable. Alternating large-star and small-star steps
    (Kiveris et al. 2014): O(log n) rounds, each a partial min per node and a
    join back, so a hub's edges are pre-aggregated and never gathered."""
    e = (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    e = stored(e, "edges")
    while True:
        n = e.count()
        # stored, so that the joins with it can split a hub's edges
        low = stored(e.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m"), "smallest-neighbours", n)
        inner = e.join(low, F.col("b") == F.col("u"), "left_semi")
        if low.count() == n and inner.isEmpty():  # stars: one edge each, to a root
            break
        # large star: each edge moves from its end b to the smallest neighbour
        # of b; hubs are nobody's larger end, so they are not in ``low``
        large = e.join(low, F.col("b") == F.col("u"), "left").select("a", F.coalesce("m", "b").alias("b")).distinct()
        large = stored(large, "large-star", n)
        # small star: all smaller neighbours of a node meet at the smallest
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
            .distinct()
        )
        e = stored(small, "small-star", n)
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
