"""HTML operators over pages (no SQL form; tests hold them against written pages), and comparisons of their results."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import html as H
from corpusloom.operators import checks, compare
from corpusloom.session import spread, table
from corpusloom.sources import channels


def pages(spark, d):
    return spread(table(spark, d, "pages"))


def listing_links(spark, d):
    return channels.channel_entries(pages(spark, d).select(F.col("url").alias("document_url"), F.col("html").alias("body")))


def versions(spark, d):
    """Blocks that the extractor keeps against all that a version without block selection would keep, by the rule that decided."""
    now = H.block_decisions(pages(spark, d)).select("page_id", "text", "role", "rule")
    return compare.block_changes(now, now.where("role = 'body'"), "page_id", "text", "rule")


def violations(spark, d):
    """Conversations as a bundle (conversations are documents, turns sentences) with three planted faults."""
    t = table(spark, d, "conversations").select("conv_id", "turn", "role")
    documents = t.groupBy("conv_id").agg(F.count("*").alias("turns")).withColumn("turns", F.when(F.col("conv_id") == 4, F.col("turns") + 1).otherwise(F.col("turns")))
    rows = t.where("NOT (conv_id = 6 AND turn = 0)")
    found = checks.union(
        spark, checks.dense(rows, "order", "conv_id", "turn"), checks.equal_counts(documents.where("conv_id <> 6"), "count", "conv_id", "turns", rows, "conv_id"),
        checks.references(rows, "conversation", "turn", "conv_id", documents.where("conv_id <> 8"), "conv_id"),
    )
    return found


def relation_moves(spark, d):
    """Order pairs as relations: of two runs, one lacks each fifth and classes another seventh anew."""
    r = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("document_id"), F.col("l_partkey").alias("target_document_id"), F.col("l_returnflag").alias("text_match")).groupBy("document_id", "target_document_id").agg(F.min("text_match").alias("text_match"))
    after = r.where("document_id % 5 <> 0").withColumn("text_match", F.when(F.col("document_id") % 7 == 0, "Z").otherwise(F.col("text_match")))
    return compare.relation_moves(r.where("document_id % 6 <> 1"), after).groupBy("move").agg(F.count("*").alias("relations"))


def contexts(spark, d):
    t = table(spark, d, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", " ")).alias("position", "form"))
    return compare.in_context(t, "turn", "conv_id", "position", "form").select("conv_id", "turn", F.length("text").alias("n"), F.length("before").alias("n_before"), F.length("after").alias("n_after"))


QUERIES = {
    "html_segments": lambda spark, d: H.segments(pages(spark, d)),
    "html_extraction": lambda spark, d: H.extract(pages(spark, d)),
    "html_block_decisions": lambda spark, d: H.block_decisions(pages(spark, d)),
    "html_metadata": lambda spark, d: H.page_metadata(pages(spark, d)),
    "html_visible_text": lambda spark, d: H.visible_text(pages(spark, d)),
    "html_inert": lambda spark, d: H.inert_pages(pages(spark, d)),
    "listing_links": listing_links,
    "extraction_versions": versions,
    "bundle_violations": violations,
    "relation_moves": relation_moves,
    "sentence_contexts": contexts,
}
ORACLE = {
    "bundle_violations": "SELECT 'order' AS \"check\", '6' AS key, 'rows: ' || (count(*) - 1) AS detail FROM conversations WHERE conv_id = 6 HAVING count(*) > 1 UNION ALL SELECT 'count', '4', 'found: ' || count(*) FROM conversations WHERE conv_id = 4 HAVING count(*) > 0 UNION ALL SELECT 'conversation', turn::VARCHAR, '8' FROM conversations WHERE conv_id = 8",
    "relation_moves": "WITH r AS (SELECT l_orderkey AS a, l_partkey AS b FROM lineitem GROUP BY ALL) SELECT CASE WHEN a % 6 = 1 THEN 'new' WHEN a % 5 = 0 THEN 'lost' WHEN a % 7 = 0 THEN 'moved' ELSE 'kept' END AS move, count(*) AS relations FROM r WHERE NOT (a % 6 = 1 AND a % 5 = 0) GROUP BY 1",
    "sentence_contexts": "SELECT conv_id, turn, length(text) AS n, length(lag(text) OVER w) AS n_before, length(lead(text) OVER w) AS n_after FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)",
}
