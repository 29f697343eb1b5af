"""Document selection: the filter language, populations and their totals, coverage, release differences, record digests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.states import guarded, known_sum

#: Fields with a set clause, and with a range clause under its two names; these fields may be unknown.
SETS = ("country_id", "outlet_id", "export_id", "cohort", "date_basis")
RANGES = {"date": ("from", "to"), "tokens_counted": ("min", "max"), "audio_ms": ("min", "max")}
STATEFUL = ("cohort", "date_basis", "date", "tokens_counted", "audio_ms")


def compile_clause(clause: dict) -> Column:
    """A clause of the document filter language as a predicate that is never null; ValueError for one that isn't of it."""
    name, operators = clause.get("field"), sorted(k for k in clause if k != "field")
    if name in SETS and operators == ["in"]:
        test = F.col(name).isin(list(clause["in"])) if clause["in"] else F.lit(False)
    elif name in RANGES and operators and set(operators) <= set(RANGES[name]):
        low, high = RANGES[name]
        test = F.lit(True)
        if low in clause:
            test = test & (F.col(name) >= F.lit(clause[low]))
        if high in clause:
            test = test & (F.col(name) <= F.lit(clause[high]))
    else:
        raise ValueError(f"{name!r} with {operators} is not a clause")
    return guarded(name, test) if name in STATEFUL else F.coalesce(test, F.lit(False))


def compile_filter(clauses: list[dict]) -> Column:
    """The conjunction; an empty one selects everything."""
    return reduce(lambda a, b: a & b, map(compile_clause, clauses), F.lit(True))


def population(documents: DataFrame, filters: dict[str, list[dict]]) -> DataFrame:
    """Documents selected by exactly one filter for each corpus of the input."""
    missing = {r[0] for r in documents.select("corpus_id").distinct().limit(len(filters) + 1).collect()} - filters.keys()  # one row for each corpus
    if missing:
        raise ValueError(f"no filter for {sorted(missing)}")
    return reduce(DataFrame.unionByName, [documents.where((F.col("corpus_id") == corpus) & compile_filter(clauses)) for corpus, clauses in filters.items()])


def population_problems(selected: DataFrame, excluded: DataFrame, wanted: DataFrame) -> DataFrame:
    """Ids by which selected and excluded together miss or exceed what the filter gives."""
    stated = selected.select("document_id").union(excluded.select("document_id"))
    missing = wanted.select("document_id").exceptAll(stated).withColumn("problem", F.lit("not_stated"))
    return missing.unionByName(stated.exceptAll(wanted.select("document_id")).withColumn("problem", F.lit("not_in_filter")))


COVERAGE_KEYS = ("country_id", "outlet_id", "cohort", "cohort_state", "date_basis", "date_basis_state")


def coverage(documents: DataFrame) -> DataFrame:
    """Documents and stateful sums by country, outlet, cohort and date basis; unknown cohorts are groups of their own."""
    return documents.groupBy(*COVERAGE_KEYS).agg(F.count("*").alias("documents"), *known_sum("tokens_counted"), *known_sum("audio_ms"))


def totals(selected: DataFrame) -> DataFrame:
    """Records, distinct documents and stateful sums of each corpus."""
    return selected.groupBy("corpus_id").agg(F.count("*").alias("records"), F.count_distinct("document_id").alias("documents"), *known_sum("tokens_counted"), *known_sum("audio_ms"))


def changes(before: DataFrame, after: DataFrame, key: str, content: list[str]) -> DataFrame:
    """added, removed, replaced or kept for each key of two releases."""
    mark = F.sha2(F.to_json(F.struct(*content)), 256)
    old, new = before.select(key, mark.alias("old")), after.select(key, mark.alias("new"))
    kind = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old") != F.col("new"), "replaced").otherwise("kept")
    return old.join(new, key, "full_outer").select(key, kind.alias("change"))


def record_set_digest(rows: DataFrame, line: Column, buckets: int = 4096) -> DataFrame:
    """One digest of a set of lines that does not depend on their order: bucket digests of sorted lines, then theirs.

    A bucket holds a 1/4096 of the lines; `buckets` grows with the data where that is too much for a task.
    """
    lines = rows.select(F.sha2(line, 256).alias("h"))
    per = lines.groupBy(F.conv(F.substring("h", 1, 4), 16, 10).cast("int").alias("bucket")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256).alias("d"))
    return per.agg(F.sha2(F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("bucket", "d"))), lambda x: x["d"])), 256).alias("digest"))
