"""Record-set operators over the TPC-H-like tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import records as R
from corpusloom.session import table


def morph(spark, d):
    """Line items as tokens."""
    values = F.create_map(F.lit("Number"), F.when(F.col("l_quantity") > 25, "Plur").when(F.col("l_quantity") > 5, "Sing"), F.lit("Gender"), F.lit("Fem"))
    rows = table(spark, d, "lineitem").select(F.col("l_linestatus").alias("modality"), F.col("l_returnflag").alias("upos"), (F.col("l_linenumber") != 1).alias("counted"), values.alias("morph"))
    return R.morph_counts(rows, "Number", "N")


def totals(spark, d):
    """Customers' numbers of orders and cents as stated, some wrong, against their orders."""
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.lit(1).alias("orders"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    stated = o.groupBy("k").agg(F.sum("orders").alias("orders"), F.sum("cents").alias("cents")).where("k % 17 <> 3").select("k", (F.col("orders") + F.when(F.col("k") % 11 == 0, 1).otherwise(0)).alias("orders"), (F.col("cents") - F.when(F.col("k") % 13 == 0, 5).otherwise(0)).alias("cents"))
    return R.totals_differ(stated, o, "k", ["orders", "cents"])


def restorable(spark, d):
    unique = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"))
    li = unique.select((F.col("l_orderkey") % 8).alias("release"), F.concat_ws(":", "l_orderkey", "l_linenumber").alias("document"), F.col("l_partkey").alias("content"), F.col("l_linenumber").alias("n"))
    pinned = li.where("release <> 5 and n % 4 <> 3").select("release", "document", F.when(F.col("content") % 9 == 0, -1).otherwise(F.col("content")).alias("content"))
    return R.restorable(li.drop("n"), pinned).groupBy("release", "problem").agg(F.count("*").alias("documents"))


def aliases(spark, d):
    """Suppliers as outlets with two old slugs each; customers ask by nation and market segment."""
    registry = table(spark, d, "supplier").select(F.col("s_suppkey").alias("outlet"), F.col("s_nationkey").alias("country"), F.array((F.col("s_suppkey") % 5).cast("string"), (F.col("s_suppkey") % 3).cast("string")).alias("slugs"))
    return R.aliases(table(spark, d, "customer").select(F.col("c_nationkey").alias("country"), (F.col("c_custkey") % 6).cast("string").alias("slug")), registry)


def waves(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_orderpriority").alias("authorization"), (F.col("o_custkey") % 20).alias("manifest"), (F.col("o_orderkey") % 5000).alias("wave"))
    return R.waves_used(rows, "1-URGENT", 7)


def population(spark, d):
    return R.population(table(spark, d, "documents").select(F.coalesce("source", F.lit("")).alias("outlet"), F.col("doc_id").alias("id"), F.coalesce("n_chars", F.lit(0)).alias("at")))


def expanded(spark, d):
    """Parts name three others each; two roots; four levels of at most 200."""
    p = F.col("p_partkey")
    edges = table(spark, d, "part").select(p.alias("parent"), F.explode(F.array(p * 2 + 1, p * 3 % 1999, p - 5)).alias("url"), (p % 10).alias("rank")).where("url >= 0")
    return R.expanded(edges, spark.range(2).select(F.col("id").alias("url")), 4, 200)


QUERIES = {
    "morph_counts": morph,
    "totals_differ": totals,
    "restorable": restorable,
    "legacy_aliases": aliases,
    "waves_used": waves,
    "population_manifest": population,
    "channel_expansion": expanded,
    "ranked": lambda spark, d: R.ranked(table(spark, d, "customer").select("c_mktsegment", "c_acctbal", "c_custkey"), "c_mktsegment", "c_acctbal", "c_custkey", 7).withColumn("around", F.round(F.col("around") * 100).cast("long")),
}
_LEVEL = lambda k: f"n{k} AS (SELECT url, min((rank, e.parent)) AS b FROM e JOIN l{k - 1} x ON e.parent = x.u WHERE x.level = {k - 1} AND url NOT IN (SELECT u FROM l{k - 1}) GROUP BY url ORDER BY b[1], url LIMIT 200), l{k} AS (SELECT * FROM l{k - 1} UNION ALL SELECT url, {k}, b[2] FROM n{k})"
ORACLE = {
    "morph_counts": "SELECT l_linestatus AS modality, CASE WHEN l_quantity > 25 THEN 'Plur' ELSE 'Sing' END AS \"value\", count(*) AS tokens FROM lineitem WHERE l_linenumber <> 1 AND l_returnflag = 'N' AND l_quantity > 5 GROUP BY ALL",
    "totals_differ": "WITH a AS (SELECT o_custkey AS k, count(*) AS orders, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS cents FROM orders GROUP BY 1), m AS (SELECT k, 'orders' AS measure, CASE WHEN k % 17 <> 3 THEN orders + CASE WHEN k % 11 = 0 THEN 1 ELSE 0 END END AS stated, orders AS found FROM a UNION ALL SELECT k, 'cents', CASE WHEN k % 17 <> 3 THEN cents - CASE WHEN k % 13 = 0 THEN 5 ELSE 0 END END, cents FROM a) SELECT * FROM m WHERE stated IS DISTINCT FROM found",
    "restorable": "SELECT l_orderkey % 8 AS release, CASE WHEN l_orderkey % 8 = 5 THEN 'no_release' WHEN l_linenumber % 4 = 3 THEN 'no_document' WHEN l_partkey % 9 = 0 THEN 'other_content' END AS problem, count(*) AS documents FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY ALL) GROUP BY ALL",
    "legacy_aliases": "WITH r AS (SELECT s_suppkey AS outlet, s_nationkey AS country, unnest([(s_suppkey % 5)::VARCHAR, (s_suppkey % 3)::VARCHAR]) AS slug FROM supplier) SELECT DISTINCT country, slug, outlet FROM (SELECT c_nationkey AS country, (c_custkey % 6)::VARCHAR AS slug FROM customer) JOIN r USING (country, slug)",
    "population_manifest": "WITH p AS (SELECT coalesce(source, '') AS outlet, sha256(doc_id::VARCHAR)[1:2] AS bucket, count(*) AS n, min(coalesce(n_chars, 0)) AS f, max(coalesce(n_chars, 0)) AS l, sha256(string_agg(doc_id::VARCHAR, chr(10) ORDER BY doc_id::VARCHAR)) AS sha FROM documents GROUP BY ALL) SELECT outlet, sum(n)::BIGINT AS members, min(f) AS \"first\", max(l) AS \"last\", sha256(string_agg(sha, chr(10) ORDER BY bucket)) AS ids_sha256 FROM p GROUP BY outlet",
    "waves_used": "SELECT DISTINCT o_orderkey % 5000 AS wave FROM orders WHERE o_orderpriority = '1-URGENT' AND o_custkey % 20 <> 7",
    "channel_expansion": f"WITH e AS (SELECT * FROM (SELECT p_partkey AS parent, unnest([p_partkey * 2 + 1, p_partkey * 3 % 1999, p_partkey - 5]) AS url, p_partkey % 10 AS rank FROM part) WHERE url >= 0), l0 AS (SELECT i AS u, 0 AS level, NULL::BIGINT AS parent FROM range(2) r(i)), {', '.join(_LEVEL(k) for k in range(1, 5))} SELECT u AS url, level, parent FROM l4",
    "ranked": "SELECT c_mktsegment, c_custkey, ntile(7) OVER w AS tile, round(percent_rank() OVER w * 1000000)::BIGINT AS percent, round(avg(c_acctbal) OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) * 100)::BIGINT AS around FROM customer WINDOW w AS (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey)",
}
