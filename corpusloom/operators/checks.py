"""Constraint checks: each gives violations (check, key, detail) and never fails on a row. Bundles are dicts of DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.states import broken

VIOLATION = "check string, key string, detail string"
# Forms of identifiers.
ID_FORMS = {"country": r"^[A-Z]{2}$", "outlet": r"^[a-z]{2}_[a-z0-9_]+$", "sha256": r"^[0-9a-f]{64}$", "schema": r"^[a-z0-9-]+/v[0-9]+$", "cohort": r"^\d{4}-Q[1-4]$"}


def _as(df: DataFrame, check: str, key: Column, detail: Column | str = "") -> DataFrame:
    return df.select(F.lit(check).alias("check"), key.cast("string").alias("key"), (F.lit(detail) if isinstance(detail, str) else detail).cast("string").alias("detail"))


def rows_where(df: DataFrame, check: str, key: str, condition: Column, detail: Column | str = "") -> DataFrame:
    return _as(df.where(F.coalesce(condition, F.lit(False))), check, F.col(key), detail)


def unique(df: DataFrame, check: str, key: str) -> DataFrame:
    again = df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    return _as(again, check, F.col(key), F.concat(F.lit("rows: "), F.col("n")))


def references(df: DataFrame, check: str, key: str, foreign: str, parent: DataFrame, parent_key: str) -> DataFrame:
    there = parent.select(F.col(parent_key).alias(foreign)).distinct()
    return _as(df.where(F.col(foreign).isNotNull()).join(there, foreign, "left_anti"), check, F.col(key), F.col(foreign))


def stateful(df: DataFrame, check: str, key: str, *fields: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [rows_where(df, check, key, broken(f), f) for f in fields])


def dense(df: DataFrame, check: str, group: str, position: str) -> DataFrame:
    bad = df.groupBy(group).agg(F.count("*").alias("n"), F.min(position).alias("lo"), F.max(position).alias("hi"), F.count_distinct(position).alias("k")).where("lo <> 0 OR hi <> n - 1 OR k <> n")
    return _as(bad, check, F.col(group), F.concat(F.lit("rows: "), F.col("n")))


def equal_counts(parent: DataFrame, check: str, key: str, stated: str, children: DataFrame, foreign: str) -> DataFrame:
    """Parents whose stated number of children is not what there is."""
    found = children.groupBy(F.col(foreign).alias(key)).agg(F.count("*").alias("found"))
    return _as(parent.join(found, key, "left").where(F.col(stated).isNotNull() & (F.col(stated) != F.coalesce("found", F.lit(0)))), check, F.col(key), F.concat(F.lit("found: "), F.coalesce("found", F.lit(0))))


def case_collisions(df: DataFrame, check: str, path: str) -> DataFrame:
    fold = df.select(path).distinct().groupBy(F.lower(path).alias("folded")).agg(F.count("*").alias("n")).where("n > 1")
    return _as(fold, check, F.col("folded"), F.concat(F.lit("paths: "), F.col("n")))


def id_form(df: DataFrame, check: str, column: str, form: str) -> DataFrame:
    return rows_where(df, check, column, F.col(column).isNotNull() & ~F.col(column).rlike(ID_FORMS[form]))


def union(spark: SparkSession, *found: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, found, spark.createDataFrame([], VIOLATION))


def first_objecting(spark: SparkSession, *phases: DataFrame) -> DataFrame:
    """The violations of the first phase that has any: later phases would only repeat its cause."""
    for phase in phases:
        if not phase.isEmpty():
            return phase
    return union(spark)


def bundle(b: dict[str, DataFrame]) -> DataFrame:
    """A corpus bundle: outlets, documents, units, sentences, tokens."""
    spark = b["documents"].sparkSession
    o, d, u, s, t = (b[k] for k in ("outlets", "documents", "units", "sentences", "tokens"))
    heads = t.join(t.select(F.col("token_id").alias("head_token_id"), F.col("sentence_id").alias("head_sentence")), "head_token_id", "left")
    return first_objecting(
        spark,
        union(spark, *[unique(x, f"unique_{k}", k) for x, k in ((o, "outlet_id"), (d, "document_id"), (u, "unit_id"), (s, "sentence_id"), (t, "token_id"))], id_form(o, "outlet_form", "outlet_id", "outlet")),
        union(
            spark,
            references(d, "document_outlet", "document_id", "outlet_id", o, "outlet_id"), references(u, "unit_document", "unit_id", "document_id", d, "document_id"),
            references(s, "sentence_unit", "sentence_id", "unit_id", u, "unit_id"), references(t, "token_sentence", "token_id", "sentence_id", s, "sentence_id"),
            _as(heads.where("head_token_id is not null and not head_sentence <=> sentence_id"), "token_head", F.col("token_id"), F.col("head_token_id")),
            stateful(d, "document_states", "document_id", "tokens_counted"), dense(s, "sentence_order", "unit_id", "position"), dense(t, "token_order", "sentence_id", "position"),
        ),
        equal_counts(d.where("tokens_counted_state = 'known'"), "tokens_counted", "document_id", "tokens_counted", t.join(s.select("sentence_id", "unit_id"), "sentence_id").join(u.select("unit_id", "document_id"), "unit_id"), "document_id"),
    )


def severity(found: DataFrame, damaged: tuple[str, ...], repairable: tuple[str, ...]) -> DataFrame:
    """CLEAN, RESUMABLE, NEEDS_REPAIR or DAMAGED: the worst of the violations."""
    rank = F.when(F.col("check").isin(*damaged), 3).when(F.col("check").isin(*repairable), 2).otherwise(1)
    names = F.array(*map(F.lit, ("CLEAN", "RESUMABLE", "NEEDS_REPAIR", "DAMAGED")))
    return found.agg(F.element_at(names, F.coalesce(F.max(rank), F.lit(0)) + 1).alias("state"), F.count("*").alias("violations"))
