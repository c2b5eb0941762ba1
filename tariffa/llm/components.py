"""Connected components of an edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffa.llm.common import checkpointed


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours (large: the greater ones, else the smaller ones and itself) linked to the least node around it."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    down = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.unionByName(least.withColumnRenamed("m", "v")).where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """u, v (longs, either order) to node, root: every node of an edge but the roots, with the least node of its component."""
    now = checkpointed(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct())
    sign = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = sign(now)
    while before[0]:
        now = checkpointed(_stars(_stars(now, True), False))
        after = sign(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
