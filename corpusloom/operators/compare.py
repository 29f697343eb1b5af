"""Comparisons of versions and runs: changed blocks, moved relations, word diffs, contexts, layers by precedence."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def block_changes(before: DataFrame, after: DataFrame, page: str, block: str, reason: str) -> DataFrame:
    """Added and removed blocks of pages between two extractor versions, counted by reason. Blocks are matched as bags."""
    a = before.groupBy(page, block).agg(F.count("*").alias("a"), F.min(reason).alias("before_reason"))
    b = after.groupBy(page, block).agg(F.count("*").alias("b"), F.min(reason).alias("after_reason"))
    both = a.join(b, [page, block], "full_outer").fillna(0, ["a", "b"])
    change = F.when(F.col("a") > F.col("b"), "removed").when(F.col("b") > F.col("a"), "added").when(~F.col("before_reason").eqNullSafe(F.col("after_reason")), "reason_moved")
    rows = both.withColumn("change", change).where("change is not null")
    return rows.groupBy("change", F.coalesce("after_reason", "before_reason").alias("reason")).agg(F.sum(F.greatest(F.abs(F.col("a") - F.col("b")), F.lit(1))).alias("blocks"), F.count_distinct(page).alias("pages"))


def relation_moves(before: DataFrame, after: DataFrame) -> DataFrame:
    """kept, moved (another class), lost or new for each (document_id, target_document_id). Both: with text_match."""
    key = ["document_id", "target_document_id"]
    a, b = before.select(*key, F.col("text_match").alias("a")), after.select(*key, F.col("text_match").alias("b"))
    return a.join(b, key, "full_outer").select(*key, F.when(F.col("a").isNull(), "new").when(F.col("b").isNull(), "lost").when(F.col("a") != F.col("b"), "moved").otherwise("kept").alias("move"))


@F.pandas_udf(DoubleType())
def word_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of words that two texts have in common in order."""
    return pd.Series([SequenceMatcher(None, (x or "").split(), (y or "").split(), autojunk=False).ratio() for x, y in zip(a, b)])


def in_context(tokens: DataFrame, sentence: str, document: str, position: str, form: str) -> DataFrame:
    """Each sentence's text with those before and after it in its document. tokens: in order by position, sentence by sentence."""
    text = tokens.groupBy(document, sentence).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(position, form))), lambda x: x[form]), " ").alias("text"))
    w = Window.partitionBy(document).orderBy(sentence)
    return text.withColumns({"before": F.lag("text").over(w), "after": F.lead("text").over(w)})


def by_precedence(df: DataFrame, key: str, rank: Column, value: str, basis: str) -> DataFrame:
    """Value and basis of the best-ranked row of each key; a conflict if the best rank has two values."""
    best = df.withColumn("rank", rank).where(F.col(value).isNotNull())
    top = best.groupBy(key).agg(F.min("rank").alias("rank"))
    return best.join(top, [key, "rank"]).groupBy(key).agg(F.min(value).alias(value), F.min_by(basis, value).alias(basis), (F.count_distinct(value) > 1).alias("conflict"))


def unrelated_templates(blocks: DataFrame, outlet: str, body: str, digest: str, at_least: int) -> DataFrame:
    """Blocks that stand in `at_least` bodies of one outlet whose other blocks differ: bodies that share a second block count once.

    The second block that names a body's kin is the smallest digest that it shares with another body of the outlet.
    """
    rows = blocks.select(outlet, body, digest).distinct()
    common = rows.groupBy(outlet, digest).agg(F.count("*").alias("bodies")).where("bodies > 1")
    shared = rows.join(common, [outlet, digest])
    kin = shared.groupBy(outlet, body).agg(F.min(digest).alias("least"), F.min_by(digest, F.struct(F.lit(1), digest)).alias("kin"), F.max(digest).alias("most"))
    seen = shared.join(kin, [outlet, body]).withColumn("name", F.when(F.col("least") != F.col(digest), F.col("least")).when(F.col("most") != F.col(digest), F.col("most")).otherwise(F.col(body).cast("string")))
    return seen.groupBy(outlet, digest).agg(F.count_distinct("name").alias("unrelated"), F.max("bodies").alias("bodies")).where(F.col("unrelated") >= at_least)
