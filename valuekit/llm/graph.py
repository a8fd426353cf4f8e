"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuekit.scale import settle


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` for every end of a link ``(a, b)``; the component is the smallest id that links reach.

    Alternating star contraction: each node hands its larger, then its smaller neighbours to the smallest one it knows,
    until nothing changes. Rounds grow with the logarithm of the longest path. Each round is written to the shared
    folder; minima combine before the shuffle, and a hub's rows go through joins that the engine can split.
    Links with a null end are ignored; repeated ones count once; a table without links gives no rows.
    """
    a, b = F.col("a"), F.col("b")
    known = links.filter(a.isNotNull() & b.isNotNull() & (a != b))
    edges = settle(known.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        edges = settle(small.unionByName(lowest.withColumnRenamed("m", "v")).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
