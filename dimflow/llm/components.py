"""Connected components of a table of links, in Spark, without collecting any."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for each node of ``a, b`` links: the smallest node it reaches.

    Alternating large and small stars: every node's neighbours are tied to the smallest of them, first
    the larger neighbours, then the others. Minima are aggregated before they are joined, so a node
    with very many links is no single group."""
    links = cut_lineage(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        links = cut_lineage(small.where("a != b").distinct())
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
