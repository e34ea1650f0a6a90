"""Connected components of a table of links, by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import materialize


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that has a link; the root is the least node of its component.

    Each step is a grouped minimum and an equi-join, so a hub with many links stays spread over tasks.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges, before = materialize(edges, "links"), None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
        edges = materialize(small.where("u <> v").distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root").unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
