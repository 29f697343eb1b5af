"""Scores of extraction arms and reviews against references: overlap and boundaries, catastrophes, summaries, disagreements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators.estimate import bag_overlap


def tokens(column: str) -> Column:
    return T.words(F.coalesce(F.col(column), F.lit("")))


def scored(outputs: DataFrame, references: DataFrame, lost_below: float, width: int = 10) -> DataFrame:
    """Each arm's output of a case held against the case's reference.

    outputs: case_id, arm, outcome, title, body (null: no output). references: case_id, title, body.
    """
    ref = references.select("case_id", F.col("title").alias("r_title"), tokens("body").alias("r"))
    return scored_beside(outputs.join(ref, "case_id"), lost_below, width)


def scored_beside(rows: DataFrame, lost_below: float, width: int = 10) -> DataFrame:
    """The same for rows that hold their reference, without a shuffle. rows: case_id, arm, outcome, title, body, r_title, r (the reference's tokens)."""
    clean = lambda c: F.trim(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"\s+", " "))
    rows = rows.withColumn("c", tokens("body"))
    rows = rows.withColumns({"n": F.size("c"), "m": F.size("r"), "shared": bag_overlap(F.col("c"), F.col("r"))})
    end = lambda w: F.slice(w, F.greatest(F.lit(1), F.size(w) - (width - 1)), F.lit(width))
    retention = F.when(F.col("m") > 0, F.col("shared") / F.col("m"))
    bad = (
        F.when(F.col("outcome").isNull(), "no_output").when(F.col("outcome") != "EXTRACTED", "not_extracted")
        .when((F.col("m") > 0) & (F.col("n") == 0), "empty_body").when(retention < lost_below, "body_mostly_lost")
    )
    has = F.col("m") > 0
    return rows.select(
        "case_id", "arm", F.col("m").cast("long").alias("reference_tokens"), F.col("n").cast("long").alias("candidate_tokens"), F.col("shared").alias("shared_tokens"),
        (clean("title") == clean("r_title")).alias("title_correct"), F.when(has, F.slice("c", 1, width) == F.slice("r", 1, width)).alias("start_matches"), F.when(has, end(F.col("c")) == end(F.col("r"))).alias("end_matches"), bad.alias("catastrophe"),
    )


def arm_summary(scores: DataFrame) -> DataFrame:
    """Per arm: cases, mean retention and excess (of those that have one), and counts, by millionths."""
    millionths = lambda c: F.floor(F.avg(c) * 1000000 + 0.5)
    retention, excess = F.when(F.col("reference_tokens") > 0, F.col("shared_tokens") / F.col("reference_tokens")), F.when(F.col("candidate_tokens") > 0, (F.col("candidate_tokens") - F.col("shared_tokens")) / F.col("candidate_tokens"))
    return scores.groupBy("arm").agg(F.count("*").alias("cases"), millionths(retention).alias("retention"), millionths(excess).alias("excess"), F.count_if("title_correct").alias("titles"), F.count_if("start_matches").alias("starts"), F.count_if("end_matches").alias("ends"), F.count("catastrophe").alias("catastrophes"))


def disagreements(outputs: DataFrame, value: str) -> DataFrame:
    """Per pair of arms: cases of both and those in which they differ. One row holds a case's arms, of which there are few."""
    arms = outputs.groupBy("case_id").agg(F.array_sort(F.collect_list(F.struct("arm", F.col(value).alias("v")))).alias("a"))
    pairs = arms.select(F.explode(F.flatten(F.transform("a", lambda x, i: F.transform(F.slice(F.col("a"), i + 2, F.size("a")), lambda y: F.struct(x["arm"].alias("first"), y["arm"].alias("second"), (~x["v"].eqNullSafe(y["v"])).alias("differ")))))).alias("p"))
    return pairs.groupBy("p.first", "p.second").agg(F.count("*").alias("cases"), F.count_if("p.differ").alias("differ"))


def stated_coverage(pairs: DataFrame, n: int = 5, edge: int = 30) -> DataFrame:
    """How many of the n-grams of a stated body a body holds: of all, of its first and of its last `edge`. pairs: id, body, stated."""
    grams = lambda c: T.grams(T.words(F.coalesce(F.col(c), F.lit(""))), n)
    rows = pairs.select("id", grams("body").alias("b"), grams("stated").alias("s"))
    rows = rows.withColumns({"s": F.array_distinct("s"), "head": F.array_distinct(F.slice("s", 1, edge)), "tail": F.array_distinct(F.slice("s", F.greatest(F.lit(1), F.size("s") - (edge - 1)), F.lit(edge)))})
    inside = lambda c: F.size(F.array_intersect(c, "b")).cast("long")  # noqa: E731  of different n-grams
    return rows.select("id", F.size("s").cast("long").alias("grams"), inside("s").alias("held"), F.size("head").cast("long").alias("head_grams"), inside("head").alias("held_head"), F.size("tail").cast("long").alias("tail_grams"), inside("tail").alias("held_tail"))


def review_class(label: Column, in_body: Column) -> Column:
    """What a reviewer's label of a block says of the machine's choice."""
    return F.when(label == "unsure", "doubt").when(label == "article", F.when(in_body, "kept_article").otherwise("false_deletion")).otherwise(F.when(in_body, "residue").otherwise("removed_foreign"))


def review_scores(judged: DataFrame) -> DataFrame:
    """Blocks, words and cases of each class by component. judged: case_id, component, label, in_body, words."""
    rows = judged.withColumn("class", review_class(F.col("label"), F.col("in_body")))
    return rows.groupBy("component", "class").agg(F.count("*").alias("blocks"), F.sum("words").alias("words"), F.count_distinct("case_id").alias("cases"))


def targeted_draw(rows: DataFrame, key: str, strata: list[tuple[str, Column, int]], order: Column) -> DataFrame:
    """Up to a quota of each stratum; a row counts in the first stratum that it meets. strata: (name, test, quota)."""
    name = F.coalesce(*[F.when(test, F.lit(n)) for n, test, _ in strata])
    quota = F.coalesce(*[F.when(F.col("stratum") == n, F.lit(q)) for n, _, q in strata])
    met = rows.select(key, name.alias("stratum"), order.alias("order")).where("stratum is not null")
    size = met.groupBy("stratum").agg(F.count("*").alias("stratum_size"))
    rank = F.row_number().over(Window.partitionBy("stratum").orderBy("order", key))
    ranked = met.withColumn("k", rank).where(F.col("k") <= max(q for _, _, q in strata)).where(F.col("k") <= quota)  # the first limit, a number, holds in each task before the shuffle
    return ranked.join(F.broadcast(size), "stratum").select(key, "stratum", "stratum_size")  # one row a stratum
