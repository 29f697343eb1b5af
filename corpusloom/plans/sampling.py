"""Reproducible draws from documents and parts; allocation and interleaving."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import sampling as S
from corpusloom.session import table


def docs(spark, d):
    return table(spark, d, "documents").select("doc_id", "source", "lang", "n_chars")


def remainder(spark, d):
    return S.largest_remainder(docs(spark, d).groupBy("lang").agg(F.count("*").alias("n")), "lang", "n", 37)


QUERIES = {
    "sample_per_stratum": lambda spark, d: S.per_stratum(docs(spark, d), ["lang", "source"], "doc_id", 3, "s1").select("doc_id", "rank"),
    "sample_capped": lambda spark, d: S.capped(docs(spark, d), "lang", "source", "doc_id", 12, 2, "s2").select("doc_id", "rank"),
    "probability_draw": lambda spark, d: S.probability_draw(docs(spark, d), "source", "doc_id", 5, "s3"),
    "largest_remainder": remainder,
    "alternating_review": lambda spark, d: S.alternate(docs(spark, d).withColumn("flag", F.col("n_chars") < 1000), "source", "flag", "doc_id", 4, "s4").select("doc_id", "rank"),
    "round_robin": lambda spark, d: S.interleaved(docs(spark, d), "source", [F.col("n_chars").desc(), F.col("doc_id")]).select("doc_id", "round"),
    "rotated_outlets": lambda spark, d: S.rotated(docs(spark, d).select("source").distinct(), "source", 3),
    "candidate_budget": lambda spark, d: S.newest_within(table(spark, d, "events").select("event_id", "event_type", F.when(F.col("user_id") % 3 != 0, F.col("ts")).alias("stated")), "event_type", "stated", "event_id", 20).select("event_id", "rank"),
    "blinded_arms": lambda spark, d: S.blinded(table(spark, d, "conversations"), "conv_id", "turn", "b").select("conv_id", "turn", "label"),
}
_K = "sha256('{}|' || doc_id)"
ORACLE = {
    "sample_per_stratum": f"SELECT doc_id, row_number() OVER (PARTITION BY lang, source ORDER BY {_K.format('s1')}, doc_id) AS rank FROM documents QUALIFY rank <= 3",
    "sample_capped": f"WITH a AS (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY {_K.format('s2')}, doc_id) AS o FROM documents) SELECT doc_id, row_number() OVER (PARTITION BY lang ORDER BY {_K.format('s2')}, doc_id) AS rank FROM (SELECT * FROM a WHERE o <= 2) QUALIFY rank <= 12",
    "probability_draw": f"WITH a AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY {_K.format('s3')}, doc_id) AS rank, count(*) OVER (PARTITION BY source) AS frame_size FROM documents) SELECT source, doc_id, rank, frame_size, least(frame_size, 5)::DOUBLE / frame_size AS inclusion, frame_size::DOUBLE / least(frame_size, 5) AS weight_items, 1.0::DOUBLE / least(frame_size, 5) AS weight_outlets FROM a WHERE rank <= 5",
    "largest_remainder": "WITH n AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1), t AS (SELECT *, n * 37 // sum(n) OVER () AS base, (n * 37) % (sum(n) OVER ()) AS rest FROM n), r AS (SELECT *, 37 - sum(base) OVER () AS remaining, row_number() OVER (ORDER BY rest DESC, lang) AS place FROM t) SELECT lang, (base + CASE WHEN place <= remaining THEN 1 ELSE 0 END)::BIGINT AS places FROM r",
    "alternating_review": f"WITH a AS (SELECT *, n_chars < 1000 AS flag FROM documents), b AS (SELECT *, row_number() OVER (PARTITION BY source, flag ORDER BY {_K.format('s4')}, doc_id) AS turn FROM a) SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY turn, flag DESC) AS rank FROM b QUALIFY rank <= 4",
    "round_robin": "SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS round FROM documents",
    "rotated_outlets": "WITH s AS (SELECT DISTINCT source FROM documents) SELECT source, (row_number() OVER (ORDER BY source) - 1 - 3 + count(*) OVER ()) % count(*) OVER () AS turn FROM s",
    "candidate_budget": "WITH a AS (SELECT event_id, event_type, CASE WHEN user_id % 3 <> 0 THEN ts END AS stated FROM events) SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY stated IS NULL, stated DESC, event_id) AS rank FROM a QUALIFY rank <= 20",
    "blinded_arms": "SELECT conv_id, turn, chr((64 + row_number() OVER (PARTITION BY conv_id ORDER BY sha256('b|' || conv_id || '|' || turn), turn))::INT) AS label FROM conversations",
}
