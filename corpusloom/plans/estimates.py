"""Estimates over labels and orders; roll-ups, crosstabs, percentiles, overlaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.operators import estimate as E
from corpusloom.session import table


def _units(spark, d):
    """Labelled documents: y is quality, strata are languages, clusters sources; weights depend on the language's length."""
    rows = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars"), "doc_id")
    return rows.select(F.col("quality").cast("double").alias("y"), F.lit(1.0).alias("x"), (F.lit(1.0) + F.col("doc_id") % 3).alias("w"), F.col("lang").alias("stratum"), F.col("source").alias("cluster"), F.col("toxic").cast("double").alias("y2"))


def _micro(df, *names):
    """Doubles as millionths, so that engines that add in another order agree."""
    return df.select(*[F.round(F.col(c) * 1e6).cast("long").alias(c) if c in names else F.col(c) for c in df.columns])


def ratio(spark, d):
    return _micro(E.ratio(_units(spark, d), fpc={"en": 0.25}), "estimate", "se", "low", "high")


def difference(spark, d):
    rows = _units(spark, d).select(F.col("y").alias("y1"), F.col("x").alias("x1"), "y2", F.lit(1.0).alias("x2"), "w", "stratum", "cluster")
    return _micro(E.ratio_difference(rows), "estimate", "first", "second", "se", "low", "high")


def proportion(spark, d):
    return _micro(E.proportion(_units(spark, d)), "estimate", "se", "low", "high", "n_eff")


def rollup(spark, d):
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.rollup("n_regionkey", "n_nationkey").agg(F.count("*").alias("orders"), F.count_distinct("c_custkey").alias("customers"), F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"), F.count_if(F.col("o_orderstatus") == "F").alias("filled"))


def crosstab(spark, d):
    rows = table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus", F.year("l_shipdate").cast("long").alias("year")).agg(F.count("*").alias("n"))
    return rows.orderBy(F.desc("n"), "l_returnflag", "l_linestatus", "year").limit(10)


def percentiles(spark, d):
    """Three definitions: interpolated median cut to an integer, nth by banker's rounding, nth by truncation."""
    e = table(spark, d, "events").select("event_type", F.floor(F.col("value") * 100).alias("v"))
    median = e.groupBy("event_type").agg(F.floor(F.median("v")).alias("median"))
    n = F.col("n")
    p90 = E.nth(e, ["event_type"], "v", F.rint((n - 1) * 0.9), "p90_rounded")
    low = E.nth(e, ["event_type"], "v", F.least(n - 1, F.floor(n * 0.9)), "p90_cut")
    return median.join(p90, "event_type").join(low, "event_type")


def overlap(spark, d):
    """Each turn's words held against the words of the turn before."""
    t = table(spark, d, "conversations").select("conv_id", "turn", X.words(F.col("text")).alias("w"))
    before = t.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("w").alias("reference"))
    pairs = t.join(before, ["conv_id", "turn"]).select(F.concat_ws(":", "conv_id", "turn").alias("id"), F.col("w").alias("candidate"), "reference")
    return E.overlap(pairs)


def constant_labels(spark, d):
    """Sources of which one language has nine tenths of the documents."""
    n = table(spark, d, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"))
    top = n.groupBy("source").agg(F.max_by("lang", F.struct("n", "lang")).alias("lang"), F.max("n").alias("top"), F.sum("n").alias("total"))
    return top.withColumn("constant", F.col("top") * 10 >= F.col("total") * 9)


def site_wide(spark, d):
    """Lines that stand in many documents of a source, once a document, and their share of it in millionths."""
    line = F.explode(F.array_distinct(F.filter(F.split("text", "\n"), lambda x: F.length(x) >= 20)))
    docs = table(spark, d, "documents").select("doc_id", "source", "text")
    lines = docs.select("source", line.alias("line")).groupBy("source", "line").agg(F.count("*").alias("documents"))
    total = docs.groupBy("source").agg(F.count("*").alias("total"))
    return lines.where("documents >= 3").join(total, "source").select("source", "line", "documents", F.floor(F.col("documents") * 1000000 / F.col("total")).alias("share"))


_U = "u AS (SELECT quality::DOUBLE AS y, 1.0::DOUBLE AS x, 1.0::DOUBLE + doc_id % 3 AS w, lang AS stratum, source AS cluster, toxic::DOUBLE AS y2 FROM labels JOIN documents USING (doc_id))"
_VAR = """c AS (SELECT stratum, cluster, sum(z) AS z FROM z GROUP BY ALL), h AS (SELECT stratum, count(*) AS k, CASE WHEN count(*) > 1 THEN var_samp(z) END AS v, {rate} AS rate FROM c GROUP BY stratum),
s AS (SELECT sqrt(coalesce(sum((1 - rate) * k * v), 0)) AS se, sum(k)::BIGINT AS clusters, count(*) AS strata, sum(k)::BIGINT - count(*) AS df, coalesce(string_agg(stratum, ',' ORDER BY stratum) FILTER (k < 2), '') AS singleton_strata FROM h),
t AS (SELECT CASE WHEN df < 1 THEN NULL WHEN df > 30 THEN 1.959964 ELSE list_extract(""" + str(list(E.T975)) + """::DOUBLE[], df::INT) END AS t FROM s)"""
_R = f"{_U}, r AS (SELECT sum(w * y) / sum(w * x) AS estimate, sum(w * x) AS wx, count(*) AS n FROM u), z AS (SELECT stratum, cluster, w * (y - estimate * x) / wx AS z FROM u, r), "
_M = "round(({}) * 1e6)::BIGINT AS {}"
QUERIES = {
    "weighted_ratio": ratio,
    "ratio_difference": difference,
    "weighted_proportion": proportion,
    "region_rollup": rollup,
    "top_crosstab": crosstab,
    "percentile_forms": percentiles,
    "bag_overlap": overlap,
    "constant_labels": constant_labels,
    "site_wide_lines": site_wide,
}
ORACLE = {
    "weighted_ratio": f"WITH {_R} {_VAR.format(rate=chr(39).join(['CASE WHEN stratum = ', 'en', ' THEN 0.25 ELSE 0 END']))} SELECT {_M.format('estimate', 'estimate')}, {_M.format('se', 'se')}, {_M.format('greatest(0.0, estimate - t * se)', 'low')}, {_M.format('least(1.0, estimate + t * se)', 'high')}, n, clusters, strata, df, singleton_strata FROM r, s, t",
    "ratio_difference": f"WITH {_U}, r AS (SELECT sum(w * y) / sum(w * x) AS first, sum(w * y2) / sum(w) AS second, sum(w * x) AS d1, sum(w) AS d2, count(*) AS n FROM u), z AS (SELECT stratum, cluster, w * ((y - first * x) / d1 - (y2 - second) / d2) AS z FROM u, r), {_VAR.format(rate='0')} SELECT {_M.format('first - second', 'estimate')}, {_M.format('first', 'first')}, {_M.format('second', 'second')}, {_M.format('se', 'se')}, {_M.format('first - second - t * se', 'low')}, {_M.format('first - second + t * se', 'high')}, df, n FROM r, s, t",
    "weighted_proportion": f"WITH {_R} {_VAR.format(rate='0')}, p AS (SELECT estimate AS p, se, n, (SELECT count(*) FILTER (y <> 0) FROM u) AS k, CASE WHEN estimate > 0 AND estimate < 1 AND se > 0 THEN least(n, estimate * (1 - estimate) / (se * se)) ELSE n END AS m, clusters, strata, df FROM r, s), i AS (SELECT *, (p + 3.841458881296 / (2 * m)) / (1 + 3.841458881296 / m) AS mid, 1.959964 * sqrt(greatest(0.0, p * (1 - p) / m + 3.841458881296 / (4 * m * m))) / (1 + 3.841458881296 / m) AS half FROM p) SELECT {_M.format('p', 'estimate')}, {_M.format('se', 'se')}, {_M.format('greatest(0.0, mid - half)', 'low')}, {_M.format('least(1.0, mid + half)', 'high')}, n, k, {_M.format('m', 'n_eff')}, clusters, strata, df FROM i",
    "region_rollup": "SELECT n_regionkey, n_nationkey, count(*) AS orders, count(DISTINCT c_custkey) AS customers, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS cents, count(*) FILTER (o_orderstatus = 'F') AS filled FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ROLLUP (n_regionkey, n_nationkey)",
    "top_crosstab": "SELECT l_returnflag, l_linestatus, year(l_shipdate) AS year, count(*) AS n FROM lineitem GROUP BY ALL ORDER BY n DESC, l_returnflag, l_linestatus, year LIMIT 10",
    "percentile_forms": "WITH e AS (SELECT event_type, floor(value * 100)::BIGINT AS v FROM events WHERE value IS NOT NULL), l AS (SELECT event_type, floor(median(v))::BIGINT AS median, list_sort(list(v)) AS s, count(*) AS n FROM e GROUP BY 1) SELECT event_type, median, s[1 + round_even((n - 1) * 0.9::DOUBLE, 0)::BIGINT] AS p90_rounded, s[1 + least(n - 1, floor(n * 0.9::DOUBLE)::BIGINT)] AS p90_cut FROM l",
    "bag_overlap": r"WITH w AS (SELECT conv_id || ':' || turn AS id, conv_id, turn, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS token FROM conversations), c AS (SELECT id, conv_id, turn, token, count(*) AS n FROM w GROUP BY ALL), p AS (SELECT a.conv_id, a.turn FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn = b.turn + 1), x AS (SELECT c.id, token, n AS a, 0 AS b FROM c JOIN p USING (conv_id, turn) UNION ALL SELECT p.conv_id || ':' || p.turn, token, 0, n FROM c JOIN p ON c.conv_id = p.conv_id AND c.turn + 1 = p.turn), y AS (SELECT id, token, sum(a) AS a, sum(b) AS b FROM x GROUP BY ALL) SELECT id, sum(least(a, b))::BIGINT AS kept, sum(greatest(b - a, 0))::BIGINT AS missing, sum(greatest(a - b, 0))::BIGINT AS excess FROM y GROUP BY id",
    "constant_labels": "WITH n AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL) SELECT source, arg_max(lang, (n, lang)) AS lang, max(n) AS top, sum(n)::BIGINT AS total, max(n) * 10 >= sum(n) * 9 AS constant FROM n GROUP BY source",
    "site_wide_lines": "WITH l AS (SELECT source, unnest(list_distinct(list_filter(string_split(text, chr(10)), lambda x: length(x) >= 20))) AS line FROM documents), n AS (SELECT source, line, count(*) AS documents FROM l GROUP BY ALL HAVING count(*) >= 3), t AS (SELECT source, count(*) AS total FROM documents GROUP BY 1) SELECT source, line, documents, floor(documents * 1000000 / total)::BIGINT AS share FROM n JOIN t USING (source)",
}
