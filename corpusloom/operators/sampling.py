"""Draws by the order of SHA-256 over seed and id: the same rows on any engine, any partitioning. Also allocation and interleaving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw_key(seed: str, item: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}|"), item.cast("string")), 256)


def per_stratum(df: DataFrame, strata: list[str], item: str, k: int, seed: str) -> DataFrame:
    """k items of each stratum (all of a smaller one)."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*strata).orderBy(draw_key(seed, F.col(item)), item))).where(F.col("rank") <= k)


def capped(df: DataFrame, stratum: str, outlet: str, item: str, k: int, cap: int, seed: str) -> DataFrame:
    """k items of each stratum in hash order, at most cap of one outlet."""
    order = (draw_key(seed, F.col(item)), F.col(item))
    some = df.withColumn("of_outlet", F.row_number().over(Window.partitionBy(stratum, outlet).orderBy(*order))).where(F.col("of_outlet") <= cap)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy(stratum).orderBy(*order))).where(F.col("rank") <= k)


def probability_draw(df: DataFrame, outlet: str, item: str, k: int, seed: str) -> DataFrame:
    """k items of each outlet with their inclusion probability, and weights for items and for outlets."""
    n = F.count("*").over(Window.partitionBy(outlet))
    drawn = per_stratum(df.withColumn("frame_size", n), [outlet], item, k, seed)
    taken = F.least(F.col("frame_size"), F.lit(k))
    return drawn.select(outlet, item, "rank", "frame_size", (taken / F.col("frame_size")).alias("inclusion"), (F.col("frame_size") / taken).alias("weight_items"), (F.lit(1.0) / taken).alias("weight_outlets"))


def largest_remainder(sizes: DataFrame, stratum: str, size: str, n: int) -> DataFrame:
    """n places for strata in proportion to their sizes. sizes is small: one row a stratum."""
    total = sizes.crossJoin(F.broadcast(sizes.agg(F.sum(size).alias("total"))))
    share = total.withColumns({"base": F.floor(F.col(size) * n / F.col("total")), "rest": (F.col(size) * n) % F.col("total")})
    left = F.lit(n) - F.sum("base").over(Window.partitionBy())
    place = F.row_number().over(Window.partitionBy().orderBy(F.col("rest").desc(), stratum))
    return share.withColumns({"left": left, "place": place}).select(stratum, (F.col("base") + F.when(F.col("place") <= F.col("left"), 1).otherwise(0)).alias("places"))


def alternate(df: DataFrame, outlet: str, flag: str, item: str, k: int, seed: str) -> DataFrame:
    """k items of each outlet, flagged and unflagged in turn, each in hash order."""
    turn = F.row_number().over(Window.partitionBy(outlet, flag).orderBy(draw_key(seed, F.col(item)), item))
    return df.withColumn("turn", turn).withColumn("rank", F.row_number().over(Window.partitionBy(outlet).orderBy("turn", F.col(flag).desc()))).where(F.col("rank") <= k)


def interleaved(df: DataFrame, outlet: str, order: list[Column], name: str = "round") -> DataFrame:
    """Round-robin order over outlets: rows of round r of all outlets come before those of r + 1."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(outlet).orderBy(*order)))


def rotated(outlets: DataFrame, outlet: str, shift: int) -> DataFrame:
    """Outlets (a small table) in their order from another first one in each cycle."""
    every = Window.partitionBy()
    return outlets.withColumn("turn", F.pmod(F.row_number().over(Window.orderBy(outlet)) - 1 - shift, F.count("*").over(every)))


def newest_within(df: DataFrame, channel: str, instant: str, position: str, room: int) -> DataFrame:
    """Newest dated rows first, then undated ones in document order, at most room of each channel."""
    w = Window.partitionBy(channel).orderBy(F.col(instant).isNull(), F.col(instant).desc(), position)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= room)


def blinded(df: DataFrame, case: str, arm: str, seed: str) -> DataFrame:
    """A letter for each arm of a case, in hash order."""
    w = Window.partitionBy(case).orderBy(F.sha2(F.concat_ws("|", F.lit(seed), F.col(case).cast("string"), F.col(arm).cast("string")), 256), arm)
    return df.withColumn("label", F.char(F.row_number().over(w) + 64))
