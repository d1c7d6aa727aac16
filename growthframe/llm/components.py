"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthframe.llm.common import saved


def _state(df: DataFrame) -> tuple:
    """Row count and an order-free checksum: two numbers, whatever the size."""
    r = df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(r)


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``(node, root)`` for every node that has a link to another one; ``root`` is the smallest node it reaches.

    Each round is two grouped minima and two equi-joins. A hub with a third of all links is
    pre-aggregated for the minimum, and its side of the join is split by AQE. Rounds are written to the
    shared folder; their number grows with the logarithm of the longest path. NULL ends and self
    links are ignored; an empty table gives an empty one."""
    a, b = F.least(u, v).alias("a"), F.greatest(u, v).alias("b")
    links = saved(edges.where(F.col(u).isNotNull() & F.col(v).isNotNull()).select(a, b).where("a < b").distinct(), "links")
    before, now = None, _state(links)
    while now != before and now[0]:
        both = links.select(F.col("a").alias("x"), F.col("b").alias("y")).union(links.select("b", "a"))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.where("y > x").join(least, "x").select(F.col("m").alias("a"), F.col("y").alias("b")).distinct()
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        links = saved(small.union(low.select(F.col("m").alias("a"), "b")).distinct(), "links")
        before, now = now, _state(links)
    return links.select(F.col("b").alias("node"), F.col("a").alias("root")).union(links.select("a", "a").distinct())
