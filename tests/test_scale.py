"""Plans and intermediate rows of queries that once grew faster than their input."""

import random
from collections import Counter

from pyspark.sql import functions as F

from corpusloom import plans, session
from corpusloom.functions import text
from corpusloom.operators import estimate, joins, records, reuse

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_arm_scores_shuffle_no_tokens(spark):
    """F1, F2: each case's arms are scored in the row that holds its reference."""
    found = plan(plans.queries()["arm_scores"](spark, SF))
    assert "hashpartitioning" not in found and "Join" not in found


def test_bag_overlap(spark):
    rows = [(["a", "b", "a"], ["a", "c", "a", "a"]), ([], ["a"]), (["é", "b"], []), (["x"] * 5, ["x"] * 3), (["ab"], ["a", "b"])]
    df = spark.createDataFrame(rows, "c array<string>, r array<string>").select("c", "r", estimate.bag_overlap("c", "r").alias("n"))
    assert [r.n for r in df.collect()] == [sum((Counter(r.c) & Counter(r.r)).values()) for r in df.collect()] == [2, 0, 0, 3, 0]


def spans_by_brute_force(points, spans):
    best = {}
    for key, p in points:
        inside = [(a, i) for i, a, b in spans if p is not None and a <= p <= b]
        best[key] = max([x for x in [best.get(key), *inside] if x], default=None)
    return {k: x and x[1] for k, x in best.items()}


def test_containing_interval_against_brute_force(spark):
    """nested, touching, equal, reversed and long spans; points before zero, repeated keys, null points."""
    rng = random.Random(5)
    spans = [(i, a, a + rng.choice([-3, 0, 1, 5, 9, 60])) for i in range(120) for a in [rng.randrange(-60, 400)]]
    points = [(k % 180, rng.randrange(-80, 480)) for k in range(220)] + [(500, None)]
    got = joins.containing_interval(spark.createDataFrame(points, "id long, p long"), spark.createDataFrame(spans, "span_id long, start long, end long"), "p", ["id"], 7)
    assert {r.id: r.span_id for r in got.collect()} == spans_by_brute_force(points, spans)


def most_rows(df):
    """The greatest number of rows that a step of df's plan gave."""
    df.write.format("noop").mode("overwrite").save()
    counts = []
    df.collect()

    def walk(node):
        metric = node.metrics().get("numOutputRows")
        if metric.isDefined():
            counts.append(metric.get().value())
        for k in range(node.children().size()):
            walk(node.children().apply(k))
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            walk(node.plan())

    walk(df._jdf.queryExecution().executedPlan())
    return max(counts)


def test_points_and_spans_of_an_hour_are_not_paired(spark):
    """2,000 points in each of 2,000 spans are 4,000 rows and their answers, not 4,000,000 pairs."""
    points = spark.range(2000).select("id", (F.col("id") % 50 + 3000).alias("p"))
    spans = spark.range(2000).select(F.col("id").alias("span_id"), (F.col("id") % 60).alias("start"), (F.col("id") % 60 + 3600).alias("end"))
    assert most_rows(joins.containing_interval(points, spans, "p", ["id"], 3600)) <= 10000


def test_old_names_are_joined_once(spark):
    """3,000 rows of one name and 300 outlets are not 900,000 pairs."""
    rows = spark.range(3000).select(F.lit(1).alias("country"), F.lit("a").alias("slug"))
    registry = spark.range(300).select(F.col("id").alias("outlet"), F.lit(1).alias("country"), F.array(F.lit("a"), F.lit("b")).alias("slugs"))
    found = records.aliases(rows, registry)
    assert most_rows(found) <= 3000 and found.count() == 300


def test_a_common_passage_does_not_pair_texts(spark):
    """400 texts share one passage of ten words and nothing else; no pair meets on it, and two near copies are still found."""
    rng = random.Random(9)
    words = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    passage = words(10)
    texts = [f"{passage} {words(60)}" for _ in range(400)] + [f"{(own := words(80))} {passage} x", f"{own} {passage} y"]
    df = spark.createDataFrame([(i, "o", t) for i, t in enumerate(texts)], "doc_id long, outlet string, text string")
    made = reuse.sketched(df)
    assert [tuple(r) for r in reuse.candidates(made, made).collect()] == [(401, 400)]
    joined = spark.read.parquet([p for p in session._MADE if "/values-" in p][-1])
    assert joined.groupBy("value").count().agg(F.max("count")).first()[0] <= 2
    assert [(r.document_id, r.target_document_id, r.text_match, r.differing_words) for r in reuse.relations(df).collect()] == [(401, 400, "near_identical", 1)]


def test_words_of_ngrams_are_cut_once(spark):
    """the words are an expression of one place in the plan, not of each n-gram."""
    df = spark.range(1).select(F.lit("a b c d").alias("t"), "id").select(text.grams(text.words(F.concat("t", F.col("id").cast("string"))), 2).alias("g"))
    assert df._jdf.queryExecution().analyzed().toString().count("regexp_extract_all") == 1
    assert df.first().g == ["a b", "b c", "c d0"]
    assert spark.range(1).select(text.grams(text.words(F.lit("a")), 2).alias("g"), text.grams(text.words(F.lit(None).cast("string")), 2).alias("n")).first() == ([], [])
