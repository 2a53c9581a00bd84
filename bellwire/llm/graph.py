"""Connected components of link tables that are never brought together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bellwire.session import stored


def components(links: DataFrame) -> DataFrame:
    """``node, root``: the smallest node that each node of ``links`` (``a``, ``b``) reaches.

    Links are turned into stars round by round: every node passes its smallest neighbour to its larger
    ones (large star), then its smallest neighbour to its smaller ones (small star). The number of rounds
    grows with the logarithm of the longest path. The smallest neighbour is a partial
    aggregate, so a node with very many links isn't gathered. Each round is stored.
    """
    pairs = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    edges = stored(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state["n"] == 0 or state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = state
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # u holds the larger end of every link here, so all its neighbours are smaller.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select("v", "m").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
