"""Operators on small written tables: ties, gaps, empty groups, planted faults."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import checks, compare, estimate, graph, joins, reuse, sampling, select, sequences


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_components_chain_and_loop(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (10, 11), (11, 10), (7, 7)], "a long, b long")
    assert rows(graph.components(edges), "u") == [(2, 1), (3, 1), (4, 1), (11, 10)]
    assert graph.components(edges.limit(0)).count() == 0


def test_tree_top(spark):
    tree = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 3), (5, 6), (6, 5), (7, 99)], "id long, broader long")
    assert rows(graph.tree_top(tree), "id") == [(1, 1, 0), (2, 1, 1), (3, 1, 2), (4, 1, 3)]


def test_reuse(spark):
    words = [f"w{i}" for i in range(120)]
    base = " ".join(words)
    docs = [(1, "a", base), (2, "b", base + " x y z"), (3, "a", base + "  "), (4, "a", " ".join(words[:100])), (5, "c", "a b " * 60), (6, "c", "c b " * 60), (7, "c", None), (8, "c", "short")]
    df = spark.createDataFrame(docs, "doc_id long, outlet string, text string")
    got = {(r.document_id, r.target_document_id): (r.relation, r.text_match) for r in reuse.relations(df).collect()}
    assert got == {(2, 1): ("syndicated_copy_of", "near_identical"), (4, 1): ("duplicate_of", "contained"), (4, 2): ("syndicated_copy_of", "contained"), (3, 1): ("duplicate_of", "exact")}
    assert dict(rows(reuse.members(df), "doc_id"))[7] == 7
    assert dict(rows(reuse.members(df), "doc_id"))[3] == 1
    assert {r.doc_id: r.cluster_id for r in reuse.clusters(df).collect() if r.doc_id < 5} == {1: 1, 2: 1, 3: 1, 4: 1}
    two = {r.document_id: (r.differing_words, r.target_differing_words) for r in reuse.relations(df).where("target_document_id = 1").collect()}
    assert two == {2: (3, 0), 3: (0, 0), 4: (0, 20)}
    accents = spark.createDataFrame([(1, "a", "2026-02-01", "", "cafe\u0301 " + base), (2, "b", "2026-01-01", "", "caf\u00e9 " + base), (3, "c", None, "1", base + " z")], "doc_id long, outlet string, published string, fetched_at string, text string")
    assert {(r.document_id, r.target_document_id, r.text_match) for r in reuse.relations(accents).collect()} == {(1, 2, "exact"), (3, 2, "near_identical")}  # composed alike; the order is that of publication
    assert dict(rows(reuse.members(accents), "doc_id")) == {1: 2, 2: 2, 3: 3}


def test_reuse_with_a_hot_passage_and_many_copies(spark):
    """Every text holds one long passage; a third are copies: pairs are those of brute force."""
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(60)]
    texts = [" ".join([*passage, *[f"w{rng.randint(0, 400)}" for _ in range(rng.randint(0, 12))]]) for _ in range(40)] + [" ".join(passage)] * 25
    df = spark.createDataFrame([(k, "o", t) for k, t in enumerate(texts)], "doc_id long, outlet string, text string")
    sets = [{tuple(t.split()[i : i + 8]) for i in range(len(t.split()) - 7)} for t in texts]
    first = {t: k for k, t in reversed([*enumerate(texts)])}
    want = {(a, b) for a in first.values() for b in first.values() if b < a and len(sets[a] & sets[b]) * 10 >= 9 * min(len(sets[a]), len(sets[b]))} | {(k, first[t]) for k, t in enumerate(texts) if first[t] != k}
    assert {(r.document_id, r.target_document_id) for r in reuse.relations(df).collect()} == want


def test_streaks_and_runs(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 3, "y"), ("b", 1, "x"), ("c", 1, "y"), ("c", 1, "y")], "k string, t long, v string")
    assert rows(sequences.trailing_streak(df, "k", F.col("v") == "y", "t"), "k") == [("a", 2, 3), ("b", 0, 1), ("c", 2, 2)]
    assert rows(sequences.runs(df.where("k = 'a'"), "k", "v", "t"), "run") == [("a", 0, "x", 1), ("a", 1, "y", 2)]


def test_pacing_is_the_fold(spark):
    starts = [0, 1, 2, 50, 51, 300]
    df = spark.createDataFrame([("o", i, s) for i, s in enumerate(starts)], "k string, i0 long, t long")
    want, last = [], None
    for s in starts:
        last = s if last is None else max(s, last + 10)
        want.append(last)
    assert [r.paced for r in sequences.paced(df, "k", F.col("t"), 10, "i0").orderBy("i0").collect()] == want


@pytest.mark.parametrize(
    "history, state, due",
    [
        ([], "NEVER_FETCHED", 5),
        ([("SUCCESS", 100, "a")], "FETCHED", 100 + 3600),
        ([("SUCCESS", 100, "a"), ("NOT_MODIFIED", 200, "a")], "FETCHED", 200 + 7200),
        ([("SUCCESS", 100, "a"), ("SUCCESS", 200, "b")], "FETCHED", 200 + 3600),
        ([("SUCCESS", 0, "a"), ("SUCCESS", 7 * 86400, "a")], "SETTLED", None),
        ([("TRANSIENT_FAILURE", 10, None)], "FAILING", 610),
        ([("TRANSIENT_FAILURE", 10, None)] * 3, "SUSPENDED", 10 + 43200),
        ([("GONE", 1, None), ("NOT_FOUND", 2, None), ("GONE", 3, None)], "RETIRED", None),
        ([("NOT_FOUND", 2, None)], "ABSENT", 2 + 86400),
        ([("MOVED_PERMANENTLY", 2, None)], "MOVED", None),
        ([("REFUSED_BY_SERVER", 2, None)], "REFUSED", 2 + 172800),
        ([("DENIED_BY_POLICY", 2, None)], "DENIED", 2 + 172800),
    ],
)
def test_lifecycle(spark, history, state, due):
    listed = spark.createDataFrame([("c", 5)], "candidate_id string, first_listed long")
    past = spark.createDataFrame([("c", i, at, kind, body, None, "p") for i, (kind, at, body) in enumerate(history)], "candidate_id string, seq long, at long, kind string, body_sha256 string, not_before long, policy_version string")
    got = sequences.lifecycle(listed, past, sequences.Schedule(), "p").first()
    assert (got.state, got.due_at, got.attempts) == (state, due, len(history))


def test_ledger(spark):
    df = spark.createDataFrame([("s", 1, None, "a"), ("s", 2, "a", "b"), ("s", 3, "a", "c"), ("s", 4, "c", "a")], "subject string, seq long, previous_state string, new_state string")
    assert [(r.seq, r.problem) for r in sequences.ledger_problems(df, [(None, "a"), ("a", "b"), ("b", "c"), ("a", "c")], "subject", "seq").orderBy("seq").collect()] == [(3, "not_the_last_state"), (4, "not_allowed")]


def test_filter_language(spark):
    with pytest.raises(ValueError):
        select.compile_clause({"field": "date", "in": ["x"]})
    with pytest.raises(ValueError):
        select.compile_clause({"field": "tokens_counted"})
    df = spark.createDataFrame([(1, 5, "known"), (2, None, "unknown"), (3, 9, "known")], "document_id long, tokens_counted long, tokens_counted_state string")
    assert rows(df.where(select.compile_filter([{"field": "tokens_counted", "min": 6}])).select("document_id"), "document_id") == [(3,)]
    assert df.where(select.compile_filter([])).count() == 3


def test_record_digest_ignores_order(spark):
    df = spark.createDataFrame([(i,) for i in range(50)], "i long")
    digest = lambda d: select.record_set_digest(d, F.col("i").cast("string")).first()[0]
    assert digest(df) == digest(df.orderBy(F.desc("i")).repartition(3)) != digest(df.where("i > 0"))


def test_ratio_by_hand(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0, "a", 1), (0.0, 1.0, 1.0, "a", 2), (1.0, 1.0, 2.0, "b", 3)], "y double, x double, w double, stratum string, cluster long")
    got = estimate.ratio(df).first()
    z = [(1 - 0.75) / 4, (0 - 0.75) / 4]
    mean = sum(z) / 2
    assert got.estimate == 0.75 and math.isclose(got.se, math.sqrt(2 * sum((v - mean) ** 2 for v in z))) and got.singleton_strata == "b" and got.df == 1
    assert estimate.ratio(df.withColumn("x", F.lit(0.0))).first().estimate is None
    whole = estimate.proportion(df.withColumn("y", F.lit(1.0))).first()
    assert whole.estimate == 1.0 and whole.n_eff == 3.0 and whole.low < 1.0


def test_allocation(spark):
    sizes = spark.createDataFrame([("a", 50), ("b", 30), ("c", 20)], "s string, n long")
    assert rows(sampling.largest_remainder(sizes, "s", "n", 7), "s") == [("a", 4), ("b", 2), ("c", 1)]
    assert sampling.per_stratum(spark.createDataFrame([("a", 1), ("b", 2)], "s string, i long"), ["s"], "i", 5, "x").count() == 2


def test_interval_takes_the_latest(spark):
    points = spark.createDataFrame([(1, 15), (2, 99)], "id long, p long")
    spans = spark.createDataFrame([(1, 0, 20), (2, 10, 30), (3, 10, 12)], "span_id long, start long, end long")
    assert rows(joins.containing_interval(points, spans, "p", ["id"], 7), "id") == [(1, 2), (2, None)]


def _bundle(spark):
    make = spark.createDataFrame
    return {
        "outlets": make([("es_a",)], "outlet_id string"),
        "documents": make([("d", "es_a", 2, "known")], "document_id string, outlet_id string, tokens_counted long, tokens_counted_state string"),
        "units": make([("u", "d")], "unit_id string, document_id string"),
        "sentences": make([("s", "u", 0)], "sentence_id string, unit_id string, position long"),
        "tokens": make([("t0", "s", 0, None), ("t1", "s", 1, "t0")], "token_id string, sentence_id string, position long, head_token_id string"),
    }


def test_bundle_checks(spark):
    assert checks.bundle(_bundle(spark)).count() == 0
    for table, change, check in (
        ("outlets", lambda d: d.withColumn("outlet_id", F.upper("outlet_id")), "outlet_form"),
        ("documents", lambda d: d.withColumn("outlet_id", F.lit("es_b")), "document_outlet"),
        ("documents", lambda d: d.withColumn("tokens_counted_state", F.lit("unknown")), "document_states"),
        ("documents", lambda d: d.withColumn("tokens_counted", F.lit(3).cast("long")), "tokens_counted"),
        ("tokens", lambda d: d.withColumn("position", F.lit(1).cast("long")), "token_order"),
        ("tokens", lambda d: d.union(d.where("position = 0")), "unique_token_id"),
        ("tokens", lambda d: d.withColumn("head_token_id", F.lit("zz")), "token_head"),
    ):
        b = _bundle(spark)
        b[table] = change(b[table])
        assert {r.check for r in checks.bundle(b).collect()} >= {check}


def test_relation_moves(spark):
    a = spark.createDataFrame([(1, 2, "exact"), (3, 4, "exact"), (5, 6, "exact")], "document_id long, target_document_id long, text_match string")
    b = spark.createDataFrame([(1, 2, "exact"), (3, 4, "contained"), (7, 8, "exact")], "document_id long, target_document_id long, text_match string")
    assert rows(compare.relation_moves(a, b).select("document_id", "move"), "document_id") == [(1, "kept"), (3, "moved"), (5, "lost"), (7, "new")]


def test_scratch_tables_can_be_cleared(spark):
    from corpusloom import session

    made = session.written(spark.range(3), "trial")
    path = made.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(path)
    session.clear_scratch(spark)
    assert not os.path.exists(path)


def test_collisions_severity_precedence_and_words(spark):
    paths = spark.createDataFrame([("a/B",), ("A/b",), ("c",), ("c",)], "p string")
    found = checks.case_collisions(paths, "paths", "p")
    assert [(r.key, r.detail) for r in found.collect()] == [("a/b", "paths: 2")]
    state = lambda df: checks.severity(df, ("broken",), ("paths",)).first().state
    assert state(found) == "NEEDS_REPAIR" and state(found.limit(0)) == "CLEAN" and state(found.withColumn("check", F.lit("broken"))) == "DAMAGED" and state(found.withColumn("check", F.lit("other"))) == "RESUMABLE"
    rows = spark.createDataFrame([(1, 2, "b", "meta"), (1, 1, "a", "ld"), (2, 1, "x", "ld"), (2, 1, "y", "ld"), (3, 1, None, "ld"), (3, 4, "z", "og")], "k int, r int, v string, basis string")
    got = {r.k: (r.v, r.basis, r.conflict) for r in compare.by_precedence(rows, "k", F.col("r"), "v", "basis").collect()}
    assert got == {1: ("a", "ld", False), 2: ("x", "ld", True), 3: ("z", "og", False)}
    texts = spark.createDataFrame([("a b c d", "a b x d"), (None, "a"), ("a", "a")], "x string, y string")
    assert [round(r.q, 3) for r in texts.select(compare.word_ratio("x", "y").alias("q")).collect()] == [0.75, 0.0, 1.0]
    blocks = spark.createDataFrame([("o", b, d) for b, ds in ((1, "tu"), (2, "tu"), (3, "tv"), (4, "tw"), (5, "tx")) for d in ds], "outlet string, body int, digest string")
    got = {r.digest: r.unrelated for r in compare.unrelated_templates(blocks, "outlet", "body", "digest", 3).collect()}
    assert got == {"t": 4}  # bodies 1 and 2 share a second block and count once
