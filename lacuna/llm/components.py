"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.functions.durable import durable


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, label: the smallest node of its component, for every node but the smallest itself.

    Alternates two steps until nothing changes: every node hands its larger neighbours to its smallest one, then its
    smaller neighbours. Both are a grouped minimum and a join by the node; the number of links never grows, and the
    rounds follow the logarithm of the longest path. Links stay in tables; each round is written, so that a lost executor
    costs a re-read.
    """
    links = durable(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct())
    state = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*")
        links = durable(small.where("u != v").distinct())
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return links.select(F.col("u").alias("node"), F.col("v").alias("label"))
        state = now
