"""Connected components of an edge list, by alternating large and small stars.

Kiveris et al., "Connected Components in MapReduce and Beyond". Each round is joins
and grouped minima over edges alone; its result is written, so a lost executor costs
one round, and the driver sees two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from badgeflow.llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node of its component, for every node with an edge."""
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    current, before = stored(pairs, "components"), None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(nearest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(lowest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = stored(moved.unionByName(lowest.withColumnRenamed("m", "v")).distinct(), "components")
        now = current.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
