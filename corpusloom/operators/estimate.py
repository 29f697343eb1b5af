"""Design-based estimation: weighted ratios with linearised variance over strata and clusters, paired differences, Wilson
intervals, nth-element percentiles, bag overlap. Everything is grouped sums; only design tables of fixed size are literals."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

Z95 = 1.959964
# Student's t, 97.5 % quantile, 1 to 30 degrees of freedom.
T975 = (12.706, 4.303, 3.182, 2.776, 2.571, 2.447, 2.365, 2.306, 2.262, 2.228, 2.201, 2.179, 2.160, 2.145, 2.131, 2.120, 2.110, 2.101, 2.093, 2.086, 2.080, 2.074, 2.069, 2.064, 2.060, 2.056, 2.052, 2.048, 2.045, 2.042)


def t975(df: Column) -> Column:
    """Null below one degree of freedom, the normal quantile above thirty."""
    return F.when(df < 1, None).when(df > len(T975), F.lit(Z95)).otherwise(F.element_at(F.array(*map(F.lit, T975)), F.greatest(F.lit(1), F.least(df, F.lit(len(T975)))).cast("int")))


def wilson_of(p: Column, n: Column, z: float = Z95) -> tuple[Column, Column]:
    n = n.cast("double")
    mid = (p + z * z / (2 * n)) / (1 + z * z / n)
    half = z * F.sqrt(F.greatest(F.lit(0.0), p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    ok = n > 0
    return F.when(ok, F.greatest(F.lit(0.0), mid - half)), F.when(ok, F.least(F.lit(1.0), mid + half))


def wilson(k: Column, n: Column, z: float = Z95) -> tuple[Column, Column]:
    """Bounds for k of n; null where n is zero."""
    return wilson_of(F.try_divide(k.cast("double"), n.cast("double")), n, z)


def _variance(z: DataFrame, fpc: dict | None) -> DataFrame:
    """se, clusters, strata, df and the names of strata with one cluster. z: stratum, cluster, z."""
    by_cluster = z.groupBy("stratum", "cluster").agg(F.sum("z").alias("z"))
    rate = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in fpc.items() for x in kv]), F.col("stratum")), F.lit(0.0)) if fpc else F.lit(0.0)
    by_stratum = by_cluster.groupBy("stratum").agg(F.count("*").alias("k"), F.when(F.count("*") > 1, F.var_samp("z")).alias("v")).withColumn("part", (1 - rate) * F.col("k") * F.col("v"))
    return by_stratum.agg(
        F.sqrt(F.coalesce(F.sum("part"), F.lit(0.0))).alias("se"), F.coalesce(F.sum("k"), F.lit(0)).alias("clusters"), F.count("*").alias("strata"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("k") < 2, F.col("stratum").cast("string")))), ",").alias("singleton_strata"),
    ).withColumn("df", F.col("clusters") - F.col("strata"))


def ratio(rows: DataFrame, *, bounded: bool = True, fpc: dict | None = None) -> DataFrame:
    """One row for sum(w y) / sum(w x). rows: y, x, w, stratum, cluster. A zero denominator gives a null estimate."""
    sums = rows.agg(F.sum(F.col("w") * F.col("y")).alias("wy"), F.sum(F.col("w") * F.col("x")).alias("wx"), F.count("*").alias("n"))
    r = sums.select(F.try_divide("wy", "wx").alias("estimate"), "wx", "n")
    z = rows.crossJoin(F.broadcast(r)).select("stratum", "cluster", F.try_divide(F.col("w") * (F.col("y") - F.col("estimate") * F.col("x")), F.col("wx")).alias("z"))  # r is one row
    out = F.broadcast(r).crossJoin(_variance(z, fpc))
    low, high = F.col("estimate") - t975(F.col("df")) * F.col("se"), F.col("estimate") + t975(F.col("df")) * F.col("se")
    if bounded:
        low, high = F.when(low.isNotNull(), F.greatest(F.lit(0.0), low)), F.when(high.isNotNull(), F.least(F.lit(1.0), high))
    return out.select("estimate", "se", low.alias("low"), high.alias("high"), "n", "clusters", "strata", "df", "singleton_strata")


def ratio_difference(rows: DataFrame, *, fpc: dict | None = None) -> DataFrame:
    """One row for the difference of two ratios on the same units. rows: y1, x1, y2, x2, w, stratum, cluster."""
    w = F.col("w")
    sums = rows.agg(*[F.sum(w * F.col(c)).alias(c) for c in ("y1", "x1", "y2", "x2")], F.count("*").alias("n"))
    r = sums.select(F.try_divide("y1", "x1").alias("first"), F.try_divide("y2", "x2").alias("second"), F.col("x1").alias("d1"), F.col("x2").alias("d2"), "n")
    one = F.try_divide(F.col("y1") - F.col("first") * F.col("x1"), F.col("d1"))
    two = F.try_divide(F.col("y2") - F.col("second") * F.col("x2"), F.col("d2"))
    z = rows.crossJoin(F.broadcast(r)).select("stratum", "cluster", (w * (one - two)).alias("z"))
    out = F.broadcast(r).crossJoin(_variance(z, fpc)).withColumn("estimate", F.col("first") - F.col("second"))
    return out.select("estimate", "first", "second", "se", (F.col("estimate") - t975(F.col("df")) * F.col("se")).alias("low"), (F.col("estimate") + t975(F.col("df")) * F.col("se")).alias("high"), "df", "n")


def proportion(rows: DataFrame, *, fpc: dict | None = None) -> DataFrame:
    """A weighted proportion with a Wilson interval on the effective sample size. rows: y (0 or 1), w, stratum, cluster."""
    k = rows.agg(F.sum((F.col("y") != 0).cast("long")).alias("k"))
    out = ratio(rows.withColumn("x", F.lit(1.0)), fpc=fpc).crossJoin(F.broadcast(k))
    p, se = F.col("estimate"), F.col("se")
    effective = F.when((p > 0) & (p < 1) & (se > 0), F.least(F.col("n").cast("double"), p * (1 - p) / (se * se))).otherwise(F.col("n").cast("double"))
    out = out.withColumn("n_eff", effective)
    low, high = wilson_of(F.col("estimate"), F.col("n_eff"))
    return out.select("estimate", "se", low.alias("low"), high.alias("high"), "n", "k", "n_eff", "clusters", "strata", "df")


def nth(df: DataFrame, group: list[str], value: str, index: Column, name: str) -> DataFrame:
    """The element at a zero-based index, an expression of n, of each group's values in order."""
    own = Window.partitionBy(*group)
    ranked = df.where(F.col(value).isNotNull()).withColumns({"n": F.count("*").over(own), "at": F.row_number().over(own.orderBy(value)) - 1})
    return ranked.where(F.col("at") == index).select(*group, F.col(value).alias(name))


@F.pandas_udf(LongType())
def _shared(candidate: pd.Series, reference: pd.Series) -> pd.Series:
    return pd.Series([sum((Counter(a.split()) & Counter(b.split())).values()) for a, b in zip(candidate, reference)], dtype="int64")


def bag_overlap(candidate: Column, reference: Column) -> Column:
    """Tokens that two arrays of a row share, each as often as both have it; tokens hold no white space. Nothing is shuffled."""
    return _shared(F.array_join(candidate, " "), F.array_join(reference, " "))


def overlap(pairs: DataFrame) -> DataFrame:
    """Bag overlap of two token arrays: id, kept, missing, excess. pairs: id, candidate, reference."""
    def bag(side: str) -> DataFrame:
        return pairs.select("id", F.explode(side).alias("token")).groupBy("id", "token").agg(F.count("*").alias(side))

    both = bag("candidate").join(bag("reference"), ["id", "token"], "full_outer").fillna(0, ["candidate", "reference"])
    return both.groupBy("id").agg(F.sum(F.least("candidate", "reference")).alias("kept"), F.sum(F.greatest(F.col("reference") - F.col("candidate"), F.lit(0))).alias("missing"), F.sum(F.greatest(F.col("candidate") - F.col("reference"), F.lit(0))).alias("excess"))
