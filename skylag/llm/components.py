"""Connected components of links that lie in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from skylag.llm.common import materialise


def _written(edges: DataFrame) -> tuple[DataFrame, dict]:
    """Edges as a written table, with their number and a sum of their hashes, taken while they are written."""
    seen = Observation()
    hashes = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return materialise(edges.observe(seen, F.count("*").alias("n"), hashes.alias("sum")), "links"), seen.get


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node with a link: label is the smallest node it reaches.

    ``links`` has two long columns a and b. Large-star and small-star steps in
    turn: each ties nodes to the smallest neighbour by a minimum, which is combined
    before its shuffle, and a join, which splits a node of many links. The links
    of a round are a written table; two numbers of it reach the driver. Null ends
    and links of a node to itself tie nothing.
    """
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges, now = _written(links.where("a <> b").select(high, low).distinct())
    before = None
    while now != before and now["n"]:
        before = now
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialise(large.distinct(), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges, now = _written(small.union(least.select("a", F.col("m").alias("b"))).distinct())
    tied = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return tied.union(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
