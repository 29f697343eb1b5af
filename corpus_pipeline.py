"""The corpus pipeline: quality rules, toxicity, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the docs of the
next. All but the last return the columns of documents. A document leaves only by a rule, a score or an earlier near-duplicate;
one that stays may lose passages that an earlier document holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import packing, quality_rules, simhash, substring_dedup, toxicity
from corpusloom.llm.common import written
from corpusloom.llm.tables import BYTE_BPE


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return quality_rules.filter_quality(docs)


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; the grammar's weights are fitted on labelled documents among them."""
    return toxicity.filter_toxicity(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words or more that a document with a smaller id holds."""
    return substring_dedup.remove_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all texts with their places in sequences of at most 1024 tokens."""
    return packing.pack(docs, BYTE_BPE)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", good_quality),
    ("toxicity", civil),
    ("simhash", distinct),
    ("substring_dedup", without_repeats),
    ("packing", packed),
]
ORACLE_SQL = None  # scores, components and packings have no SQL form; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
