"""Coverage, filters and populations. Orders play the documents: priority is the outlet, the customer's nation the country."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions.states import broken, label
from corpusloom.operators import select
from corpusloom.session import table

FILTERS = {
    "even": [{"field": "country_id", "in": [1, 2, 3, 5, 8]}, {"field": "date", "from": "1996-01-01", "to": "1999-12-31"}],
    "odd": [{"field": "outlet_id", "in": ["1-URGENT", "2-HIGH"]}, {"field": "tokens_counted", "min": 3}],
}


def documents(spark, d):
    """Release-style rows: a date is unknown for each seventh order, tokens for each eleventh, audio applies to none."""
    orders, customer = table(spark, d, "orders"), table(spark, d, "customer").select("c_custkey", "c_nationkey")
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("lines"))
    rows = orders.join(customer, orders.o_custkey == customer.c_custkey).join(lines, orders.o_orderkey == lines.l_orderkey, "left")
    key = F.col("o_orderkey")
    dated, counted = key % 7 != 0, key % 11 != 0
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return rows.select(
        key.alias("document_id"), F.when(key % 2 == 0, "even").otherwise("odd").alias("corpus_id"), F.col("c_nationkey").alias("country_id"), F.col("o_orderpriority").alias("outlet_id"),
        F.when(dated, day).alias("date"), F.when(dated, "known").otherwise("unknown").alias("date_state"),
        F.when(dated, F.concat(F.year("o_orderdate"), F.lit("-Q"), F.quarter("o_orderdate"))).alias("cohort"), F.when(dated, "known").otherwise("unknown").alias("cohort_state"),
        F.when(dated, "stated").alias("date_basis"), F.when(dated, "known").otherwise("unknown").alias("date_basis_state"),
        F.when(counted, F.coalesce("lines", F.lit(0))).alias("tokens_counted"), F.when(counted, "known").otherwise("not_available").alias("tokens_counted_state"),
        F.lit(None).cast("long").alias("audio_ms"), F.lit("not_applicable").alias("audio_ms_state"),
    )


def population_verified(spark, d):
    """A population with one document dropped and one foreign document added must be reported by exactly these two."""
    wanted = select.population(documents(spark, d), FILTERS).select("document_id")
    least = wanted.agg(F.min("document_id").alias("document_id"))
    selected = wanted.join(least, "document_id", "left_anti").union(least.select(-F.col("document_id") - 1))
    return select.population_problems(selected, wanted.limit(0), wanted)


def tokens_by(spark, d):
    rows = documents(spark, d).where("tokens_counted_state = 'known'")
    return rows.groupBy(label("cohort").alias("cohort"), "corpus_id").agg(F.sum("tokens_counted").alias("tokens")).where("tokens > 0")


def release_changes(spark, d):
    rows = documents(spark, d)
    after = rows.where("document_id % 13 <> 0").withColumn("tokens_counted", F.when(F.col("document_id") % 17 == 0, F.col("tokens_counted") + 1).otherwise(F.col("tokens_counted")))
    kinds = select.changes(rows.where("document_id % 5 <> 0"), after, "document_id", ["tokens_counted", "cohort"])
    return kinds.groupBy("change").agg(F.count("*").alias("documents"))


def broken_states(spark, d):
    rows = documents(spark, d).withColumn("date", F.when(F.col("document_id") % 97 == 0, None).otherwise(F.col("date")))
    return rows.where(broken("date")).select("document_id", "date_state")


_DOCS = """n AS (SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY 1),
x AS (SELECT o_orderkey AS document_id, CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE 'odd' END AS corpus_id, c_nationkey AS country_id, o_orderpriority AS outlet_id,
 CASE WHEN o_orderkey % 7 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS date, CASE WHEN o_orderkey % 7 <> 0 THEN 'known' ELSE 'unknown' END AS date_state,
 CASE WHEN o_orderkey % 7 <> 0 THEN year(o_orderdate) || '-Q' || quarter(o_orderdate) END AS cohort, CASE WHEN o_orderkey % 7 <> 0 THEN 'known' ELSE 'unknown' END AS cohort_state,
 CASE WHEN o_orderkey % 7 <> 0 THEN 'stated' END AS date_basis, CASE WHEN o_orderkey % 7 <> 0 THEN 'known' ELSE 'unknown' END AS date_basis_state,
 CASE WHEN o_orderkey % 11 <> 0 THEN coalesce(lines, 0) END AS tokens_counted, CASE WHEN o_orderkey % 11 <> 0 THEN 'known' ELSE 'not_available' END AS tokens_counted_state
 FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN n ON o_orderkey = l_orderkey),
pop AS (SELECT * FROM x WHERE CASE WHEN corpus_id = 'even' THEN country_id IN (1, 2, 3, 5, 8) AND coalesce(date BETWEEN '1996-01-01' AND '1999-12-31', false) ELSE outlet_id IN ('1-URGENT', '2-HIGH') AND coalesce(tokens_counted >= 3, false) END)"""
_SUM = "CASE WHEN bool_and(tokens_counted_state = 'known') THEN sum(tokens_counted)::BIGINT END AS tokens_counted, CASE WHEN bool_and(tokens_counted_state = 'known') THEN 'known' WHEN count(DISTINCT tokens_counted_state) = 1 THEN max(tokens_counted_state) ELSE 'not_available' END AS tokens_counted_state, NULL::BIGINT AS audio_ms, 'not_applicable' AS audio_ms_state"

QUERIES = {
    "coverage": lambda spark, d: select.coverage(documents(spark, d)),
    "filtered_population": lambda spark, d: select.population(documents(spark, d), FILTERS).select("document_id", "corpus_id"),
    "study_totals": lambda spark, d: select.totals(select.population(documents(spark, d), FILTERS)),
    "population_verified": population_verified,
    "tokens_by_cohort": tokens_by,
    "release_changes": release_changes,
    "broken_states": broken_states,
    "record_set_digest": lambda spark, d: select.record_set_digest(table(spark, d, "labels"), F.concat_ws(",", "doc_id", "quality", "toxic")),
    "table_rows": lambda spark, d: _table_rows(spark, d),
}


def _table_rows(spark, d):
    names = ("documents", "pages", "labels", "benchmark", "conversations")
    out = None
    for name in names:
        one = table(spark, d, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


ORACLE = {
    "coverage": f"WITH {_DOCS} SELECT country_id, outlet_id, cohort, cohort_state, date_basis, date_basis_state, count(*) AS documents, {_SUM} FROM x GROUP BY country_id, outlet_id, cohort, cohort_state, date_basis, date_basis_state",
    "filtered_population": f"WITH {_DOCS} SELECT document_id, corpus_id FROM pop",
    "study_totals": f"WITH {_DOCS} SELECT corpus_id, count(*) AS records, count(DISTINCT document_id) AS documents, {_SUM} FROM pop GROUP BY corpus_id",
    "population_verified": f"WITH {_DOCS} SELECT min(document_id) AS document_id, 'not_stated' AS problem FROM pop UNION ALL SELECT -min(document_id) - 1, 'not_in_filter' FROM pop",
    "tokens_by_cohort": f"WITH {_DOCS} SELECT CASE WHEN cohort_state = 'known' THEN cohort ELSE '<' || cohort_state || '>' END AS cohort, corpus_id, sum(tokens_counted)::BIGINT AS tokens FROM x WHERE tokens_counted_state = 'known' GROUP BY 1, 2 HAVING sum(tokens_counted) > 0",
    "release_changes": f"""WITH {_DOCS}, o AS (SELECT document_id, tokens_counted, cohort FROM x WHERE document_id % 5 <> 0), a AS (SELECT document_id, CASE WHEN document_id % 17 = 0 THEN tokens_counted + 1 ELSE tokens_counted END AS tokens_counted, cohort FROM x WHERE document_id % 13 <> 0)
SELECT CASE WHEN o.document_id IS NULL THEN 'added' WHEN a.document_id IS NULL THEN 'removed' WHEN o.tokens_counted IS DISTINCT FROM a.tokens_counted OR o.cohort IS DISTINCT FROM a.cohort THEN 'replaced' ELSE 'kept' END AS change, count(*) AS documents FROM o FULL JOIN a ON o.document_id = a.document_id GROUP BY 1""",
    "broken_states": f"WITH {_DOCS} SELECT document_id, date_state FROM x WHERE document_id % 97 = 0 AND date_state = 'known'",
    "record_set_digest": "WITH h AS (SELECT sha256(concat_ws(',', doc_id, quality, toxic)) AS h FROM labels), b AS (SELECT ('0x' || h[1:4])::INT AS bucket, sha256(string_agg(h, '' ORDER BY h)) AS d FROM h GROUP BY 1) SELECT sha256(string_agg(d, '' ORDER BY bucket)) AS digest FROM b",
    "table_rows": " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n FROM {n}" for n in ("documents", "pages", "labels", "benchmark", "conversations")),
}
