"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.session import settle


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node of its component) for every node of ``edges`` (longs ``a``, ``b``).

    Each round links every node to the smallest of its neighbours, first the larger neighbours and then the smaller
    ones, until nothing changes; the number of rounds grows with the logarithm of the longest path. A round is two
    aggregations and joins on nodes (a node of very many edges is a skewed join, which Spark splits) and is written to
    the shared folder. Loops and repeated edges do no harm; null ends are left out; no edges give no row.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = settle(edges.where("a <> b").select(low.alias("a"), high.alias("b")).distinct(), "edges")
    before, state = None, _state(edges)
    while state != before:
        # Large star: every larger neighbour of a node is linked to the smallest of the node and its neighbours.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
        large = both.where("b > a").join(least, "a").select(F.col("least").alias("a"), "b").distinct()
        # Small star: every smaller neighbour of a node, and the node, are linked to the smallest of them.
        up = large.select(F.col("b").alias("a"), F.col("a").alias("b"))
        least = up.groupBy("a").agg(F.min("b").alias("least"))
        joined = up.join(least, "a").select(F.explode(F.array(F.struct(F.col("least").alias("a"), F.col("a").alias("b")), F.struct(F.col("least").alias("a"), "b"))).alias("e"))
        edges = settle(joined.select("e.a", "e.b").where("a <> b").distinct(), "edges")
        before, state = state, _state(edges)
    members = edges.select(F.col("b").alias("node"), F.col("a").alias("label"))
    return members.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("label"))).distinct()
