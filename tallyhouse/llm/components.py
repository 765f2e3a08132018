"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import stored


def _to_smallest(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Link each node's neighbours to the smallest node next to it (or itself).

    ``larger_only``: only neighbours above the node move (large star), else
    the node and its smaller neighbours do (small star).  The minimum is taken
    per node with map-side partial sums, so a hub costs no large group.
    """
    if larger_only:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        return both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    low = edges.groupBy("a").agg(F.min("b").alias("low"))          # a > b in every edge
    moved = edges.join(low, "a").filter("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(low.select("a", F.col("low").alias("b")))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b, one
    orderable type); ``component`` is the smallest node reachable.

    Rows with a null end or equal ends are ignored.  Each round is stored in
    the shared folder; the rounds end when a round changes nothing (their
    number grows with the logarithm of the longest chain).
    """
    stars = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct(), "edges")
    before = None
    while True:
        digest = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if digest == before:
            break
        before = digest
        wide = _to_smallest(stars, True).distinct()
        stars = stored(_to_smallest(wide, False).distinct(), "stars")
    roots = stars.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
