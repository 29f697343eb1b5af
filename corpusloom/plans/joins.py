"""Joins over the TPC-H-like tables, events and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import joins as J
from corpusloom.operators import graph
from corpusloom.plans.sequences import events, turns
from corpusloom.session import table

T = table


def interval_latest(spark, d):
    """Each purchase and the latest session (an hour from a sign-up on) that contains it."""
    e = events(spark, d)
    spans = e.where("event_type = 'signup'").select(F.col("event_id").alias("span_id"), F.col("s").alias("start"), (F.col("s") + 3600).alias("end"))
    return J.containing_interval(e.where("event_type = 'purchase'").select("event_id", "s"), spans, "s", ["event_id"], 3600)


def holds(spark, d):
    """Line items held by part (first) or else by supplier."""
    first = T(spark, d, "part").where("p_partkey % 40 = 0").select(F.lit("first").alias("scope"), F.col("p_partkey").alias("key"), F.lit("part").alias("hold"))
    second = T(spark, d, "supplier").where("s_suppkey % 7 = 0").select(F.lit("second").alias("scope"), F.col("s_suppkey").alias("key"), F.lit("supplier").alias("hold"))
    out = J.either_key(T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), first.unionByName(second), "l_partkey", "l_suppkey")
    return out.groupBy("hold").agg(F.count("*").alias("lines"))


def precedence(spark, d):
    """Customers matched to a supplier by equal name digits, else by equal nation, else proposed."""
    c = T(spark, d, "customer")
    exact = T(spark, d, "supplier").select(F.regexp_extract("s_name", r"(\d+)$", 1).alias("lookup_key"), F.col("s_suppkey").alias("target"))
    loose = T(spark, d, "supplier").where("s_nationkey % 3 = 0").select(F.col("s_nationkey").cast("string").alias("lookup_key"), F.col("s_suppkey").alias("target"))
    return J.cascade(c, "c_custkey", [("exact", exact, F.regexp_extract("c_name", r"(\d+)$", 1)), ("loose", loose, F.col("c_nationkey").cast("string"))])


def reconciled(spark, d):
    a = T(spark, d, "orders").where("o_orderkey % 10 <> 1").select("o_orderkey", F.col("o_orderstatus").alias("c"))
    b = T(spark, d, "orders").where("o_orderkey % 10 <> 2").select("o_orderkey", F.when(F.col("o_orderkey") % 10 == 3, "X").otherwise(F.col("o_orderstatus")).alias("c"))
    return J.reconciled(a, b, "o_orderkey", "c").groupBy("status").agg(F.count("*").alias("n"))


def request_log(spark, d):
    """Planned (views) with the first later end (clicks or errors) of the same user, if there is one."""
    e = events(spark, d)
    return J.next_match(e.where("event_type IN ('view', 'click', 'error')"), "user_id", "us", "event_id", F.col("event_type") == "view", "end_id")


def same_story(spark, d):
    """Pairs of parts of a brand that were ordered together, as sets of orders."""
    sets = T(spark, d, "lineitem").join(T(spark, d, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return J.jaccard_pairs(sets, "p_brand", "l_partkey", "l_orderkey")


def replies(spark, d):
    """Turns with the turn they answer (a self join on the position before), and orphans without one."""
    t = turns(spark, d).select("conv_id", "turn", "role")
    head = t.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("head_role"))
    return t.join(head, ["conv_id", "turn"], "left")


def taxonomy(spark, d):
    """Tops of a tree of part keys in which a third is the broader of three; key 7 lies on a loop."""
    key = F.col("p_partkey")
    tree = T(spark, d, "part").select(key.alias("id"), F.when(key == 0, None).when(key == 7, F.lit(22)).otherwise(F.floor(key / 3)).cast("long").alias("broader"))
    return graph.tree_top(tree)


QUERIES = {
    "orphans": lambda spark, d: J.orphans(T(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), T(spark, d, "orders").where("o_orderkey % 9 <> 4"), "l_orderkey", "o_orderkey"),
    "reconciled": reconciled,
    "interval_latest": interval_latest,
    "holds_by_either_key": holds,
    "precedence_cascade": precedence,
    "request_log": request_log,
    "unfinished_requests": lambda spark, d: request_log(spark, d).where("end_id is null").select("event_id"),
    "duplicate_of": lambda spark, d: J.earliest_holder(T(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha")), "sha", "doc_id", "doc_id"),
    "shared_between_corpora": lambda spark, d: J.shared_between(T(spark, d, "lineitem"), "l_partkey", "l_returnflag"),
    "same_story": same_story,
    "replies": replies,
    "taxonomy_top": taxonomy,
    "holdout_frame": lambda spark, d: T(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha")).join(T(spark, d, "labels").select("doc_id"), "doc_id", "left_anti").join(T(spark, d, "documents").join(T(spark, d, "labels").select("doc_id"), "doc_id", "left_semi").select(F.sha2("text", 256).alias("sha")), "sha", "left_anti").select("doc_id"),
}
_E = "e AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) AS us, epoch_us(ts) // 1000000 AS s FROM events)"
_LOG = f"{_E}, v AS (SELECT * FROM e WHERE event_type = 'view'), log AS (SELECT v.event_id, arg_min(x.event_id, (x.us, x.event_id)) AS end_id FROM v LEFT JOIN e x ON x.user_id = v.user_id AND x.event_type IN ('click', 'error') AND x.us > v.us GROUP BY 1)"
ORACLE = {
    "orphans": "SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderkey % 9 <> 4)",
    "reconciled": "SELECT CASE WHEN o_orderkey % 10 = 2 THEN 'missing' WHEN o_orderkey % 10 = 1 THEN 'not_listed' WHEN o_orderkey % 10 = 3 THEN 'differs' ELSE 'same' END AS status, count(*) AS n FROM orders GROUP BY 1",
    "interval_latest": f"WITH {_E}, p AS (SELECT event_id, s FROM e WHERE event_type = 'purchase'), x AS (SELECT event_id AS span_id, s AS a, s + 3600 AS b FROM e WHERE event_type = 'signup') SELECT p.event_id, arg_max(span_id, (a, span_id)) AS span_id FROM p LEFT JOIN x ON p.s BETWEEN a AND b GROUP BY 1",
    "holds_by_either_key": "SELECT CASE WHEN l_partkey % 40 = 0 AND EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey) THEN 'part' WHEN l_suppkey % 7 = 0 AND EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey) THEN 'supplier' END AS hold, count(*) AS lines FROM lineitem GROUP BY 1",
    "precedence_cascade": r"WITH x AS (SELECT regexp_extract(s_name, '(\d+)$', 1) AS k, min(s_suppkey) AS t FROM supplier GROUP BY 1), y AS (SELECT s_nationkey AS k, min(s_suppkey) AS t FROM supplier WHERE s_nationkey % 3 = 0 GROUP BY 1) SELECT c_custkey, CASE WHEN x.t IS NOT NULL THEN 'exact' WHEN y.t IS NOT NULL THEN 'loose' ELSE 'proposal' END AS basis, coalesce(x.t, y.t) AS target FROM customer LEFT JOIN x ON x.k = regexp_extract(c_name, '(\d+)$', 1) LEFT JOIN y ON y.k = c_nationkey",
    "request_log": f"WITH {_LOG} SELECT * FROM log",
    "unfinished_requests": f"WITH {_LOG} SELECT event_id FROM log WHERE end_id IS NULL",
    "duplicate_of": "SELECT doc_id, f AS first_doc_id FROM (SELECT doc_id, first(doc_id) OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS f FROM documents WHERE text IS NOT NULL) WHERE f <> doc_id",
    "shared_between_corpora": "SELECT l_partkey, count(DISTINCT l_returnflag) AS groups FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) > 1",
    "same_story": "WITH r AS (SELECT DISTINCT p_brand, l_partkey, l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey), n AS (SELECT p_brand, l_partkey, count(*) AS n FROM r GROUP BY ALL), p AS (SELECT a.p_brand, a.l_partkey, b.l_partkey AS other, count(*) AS shared FROM r a JOIN r b ON a.p_brand = b.p_brand AND a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey GROUP BY ALL) SELECT p.*, x.n + y.n - shared AS \"union\" FROM p JOIN n x ON x.l_partkey = p.l_partkey JOIN n y ON y.l_partkey = p.other",
    "replies": "SELECT a.conv_id, a.turn, a.role, b.role AS head_role FROM conversations a LEFT JOIN conversations b ON a.conv_id = b.conv_id AND a.turn = b.turn + 1",
    "taxonomy_top": "WITH RECURSIVE t AS (SELECT p_partkey AS id, CASE WHEN p_partkey = 0 THEN NULL WHEN p_partkey = 7 THEN 22 ELSE p_partkey // 3 END AS broader FROM part), w AS (SELECT id, id AS top, 0 AS depth FROM t WHERE broader IS NULL UNION ALL SELECT t.id, w.top, w.depth + 1 FROM t JOIN w ON t.broader = w.id) SELECT * FROM w",
    "holdout_frame": "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))",
}
