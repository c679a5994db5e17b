"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.llm.common import stored


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root): the smallest node that each node of the links reaches.

    Alternates two steps (large star, small star) that hang neighbours on the smallest one
    around, until nothing changes; the rounds grow with the logarithm of the longest path. The
    links of a hub are never gathered: minima are aggregated, and the joins that bring them
    back can be split. Every round is written to the shared folder. Nodes are non-null longs.
    """
    high, low = F.greatest(left, right), F.least(left, right)
    edges = stored(
        links.select(high.alias("u"), low.alias("v")).where("u <> v").distinct(), "links"
    )
    mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    while mark[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m")
        )
        edges = stored(
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m"))
            .withColumnRenamed("m", "v").distinct(),
            "links",
        )
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        edges = stored(
            edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m"))
            .union(least).withColumnRenamed("m", "v").distinct(),
            "links",
        )
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select("v", "v").distinct())
