"""Connected components by alternating large-star and small-star rounds; every round ends in a reliable checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import cut


def _least(edges: DataFrame) -> DataFrame:
    """Smallest neighbour of each u; checkpointed, so that its join has exchanges of its own that Spark can split when skewed."""
    return cut(edges.groupBy("u").agg(F.min("v").alias("m")))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(u, v): the smallest id v that each id u with an edge reaches, for u other than v. edges: two bigint columns."""
    a, b = (F.col(c) for c in edges.columns[:2])
    now = cut(edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = cut(both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        least = _least(large)
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        before, mark = mark, _mark(now)
        if before == mark:
            break
    return now


def tree_top(concepts: DataFrame, max_depth: int = 32) -> DataFrame:
    """(id, top, depth) of each concept of a tree (id, broader): the walk up to the concept without a broader one.

    A concept on a loop, or below one, reaches no top and is left out; the walk is doubled in each round.
    """
    at = cut(concepts.select("id", F.coalesce("broader", "id").alias("up"), F.when(F.col("broader").isNull(), 0).otherwise(1).cast("long").alias("depth")))
    rounds = 1
    while rounds < max_depth:
        step = at.select(F.col("id").alias("up"), F.col("up").alias("higher"), F.col("depth").alias("more"))
        at = cut(at.join(step, "up", "left").select("id", F.coalesce("higher", "up").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")))
        rounds *= 2
    roots = concepts.where("broader is null").select(F.col("id").alias("up"))
    return at.join(roots, "up", "left_semi").select("id", F.col("up").alias("top"), "depth")
