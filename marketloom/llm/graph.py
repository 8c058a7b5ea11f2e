"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node that each node of (a, b) is linked to.

    Alternates large and small stars: every node hands its neighbours to its least one, so
    paths shorten by halves and the number of rounds is about the logarithm of the longest.
    Neighbours are never gathered: a round is two sums over links and two joins.
    """
    ends = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    edges = written(links.filter("a <> b").select(*ends).distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("a"), F.min("b")).alias("m"))
        # Large star: neighbours above a node go to its least neighbour.
        above = both.filter("b > a").join(least, "a")
        large = above.select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.filter("a <> b").distinct(), "links")
        # Small star: a node and its neighbours below it go to the least of them.
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a")
        handed = small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        new = written(
            handed.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct(), "links"
        )
        # A forest of stars is final: every node has one link, to a node without any.
        tangled = new.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.min("b").alias("b"))
        heads = new.select(F.col("a").alias("b")).distinct()
        open_links = tangled.filter("n > 1").select("a").unionByName(
            tangled.join(heads, "b", "left_semi").select("a")
        )
        edges = new
        if open_links.isEmpty():
            break
    lone = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        lone.select("node", F.col("node").alias("component"))
    )
