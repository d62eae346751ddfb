"""Connected components by alternating large and small stars, on written edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editflow.llm.common import few_files, saved


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``links`` (a, b: long) -> ``node, root``: the smallest node that each linked node reaches.

    Each round halves the depth of every tree; aggregation is partial before its shuffle and the
    joins carry two numbers a row, which adaptive execution splits at a hub.
    """
    edges = saved(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    rows, before = edges.count(), None  # no round makes more rows than there are edges
    for _ in range(max_rounds):
        # Large star: every larger neighbour of u goes to the smallest of u and its neighbours.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = saved(few_files(large.distinct(), rows), "large-star")
        # Small star: u and its smaller neighbours go to the smallest of them.
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = small.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct()
        edges = saved(few_files(small, rows), "small-star")
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
