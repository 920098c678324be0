"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomeworks.staging import stage


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b): root is the smallest node reachable.

    Each round hangs the larger neighbours of a node, then the smaller ones, on
    the smallest of them.  The edges never become more, and after a number of
    rounds that grows with the logarithm of the table every node hangs on its root.  A node
    with very many neighbours is only ever aggregated to its minimum; the joins
    that spread the minimum may be split.
    """
    # larger node first
    edges = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stage(edges, "edges")
    before = _checksum(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # of every node the neighbours above it go to the smallest one around it
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.where("a != b").distinct(), "edges")
        # then those below it
        small_min = large.groupBy("a").agg(F.min("b").alias("m"))
        spread = large.join(small_min, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = spread.unionByName(small_min.select("a", F.col("m").alias("b"))).where("a != b").distinct()
        edges = stage(edges, "edges")
        after = _checksum(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
