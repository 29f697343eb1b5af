"""Text reuse over documents (source stands for the outlet)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import reuse
from corpusloom.session import table


def _docs(spark, d):
    return table(spark, d, "documents").select("doc_id", F.col("source").alias("outlet"), "text")


_SKETCHES = r"""
canon AS (SELECT doc_id, source, nfc_normalize(text) AS text, sha256(trim(regexp_replace(regexp_replace(nfc_normalize(text), '[\x{00AD}\x{200B}\x{200C}\x{200D}\x{2060}\x{FEFF}]', '', 'g'), '[\s\x{00A0}]+', ' ', 'g'))) AS sha FROM documents),
member AS (SELECT doc_id, CASE WHEN sha IS NULL THEN doc_id ELSE min(doc_id) OVER (PARTITION BY sha) END AS representative FROM canon),
every AS (SELECT doc_id, source, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM canon),
w AS (SELECT * FROM every WHERE doc_id IN (SELECT representative FROM member)),
g AS (SELECT doc_id, source, len(w) AS words, list_sort(list_distinct([('0x' || substr(md5(array_to_string(w[i:i+7], ' ')), 1, 15))::BIGINT for i in range(1, len(w) - 6)])) AS s FROM w WHERE len(w) >= 50),
v AS (SELECT doc_id, unnest(s[1:32]) AS value FROM g),
p AS (SELECT a.doc_id, b.doc_id AS target FROM v a JOIN v b ON a.value = b.value AND a.doc_id > b.doc_id GROUP BY ALL HAVING count(*) >= 4),
r AS (SELECT p.doc_id, p.target, a.source AS o, b.source AS t_o, a.words, b.words AS t_words, len(a.s) AS n, len(b.s) AS m, len(list_intersect(a.s, b.s)) AS common FROM p JOIN g a ON p.doc_id = a.doc_id JOIN g b ON p.target = b.doc_id),
k AS (SELECT * FROM r WHERE common * 10 >= least(n, m) * 9),
c AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(w) AS word FROM w WHERE doc_id IN (SELECT doc_id FROM k UNION SELECT target FROM k)) GROUP BY ALL),
b AS (SELECT k.doc_id, k.target, sum(least(x.n, y.n))::BIGINT AS same FROM k JOIN c x ON k.doc_id = x.doc_id JOIN c y ON k.target = y.doc_id AND x.word = y.word GROUP BY ALL),
rel AS (SELECT doc_id AS document_id, target AS target_document_id, CASE WHEN o IS NOT DISTINCT FROM t_o THEN 'duplicate_of' ELSE 'syndicated_copy_of' END AS relation,
  CASE WHEN common * 10 >= greatest(n, m) * 9 THEN 'near_identical' ELSE 'contained' END AS text_match, common AS shared_shingles, n AS shingles, m AS target_shingles, words, t_words AS target_words,
  words - coalesce(same, 0) AS differing_words, t_words - coalesce(same, 0) AS target_differing_words FROM k LEFT JOIN b USING (doc_id, target)
 UNION ALL SELECT m.doc_id, m.representative, CASE WHEN a.source IS NOT DISTINCT FROM g.source THEN 'duplicate_of' ELSE 'syndicated_copy_of' END, 'exact', len(g.s), len(g.s), len(g.s), g.words, g.words, 0, 0
  FROM member m JOIN every a ON m.doc_id = a.doc_id JOIN g ON g.doc_id = m.representative WHERE m.doc_id <> m.representative)
"""

QUERIES = {
    "text_reuse_relations": lambda spark, d: reuse.relations(_docs(spark, d)),
    "text_reuse_members": lambda spark, d: reuse.members(_docs(spark, d)),
    "text_reuse_clusters": lambda spark, d: reuse.clusters(_docs(spark, d)),
    "benchmark_contamination": lambda spark, d: reuse.contamination(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "benchmark")),
}
ORACLE = {
    "text_reuse_relations": f"WITH {_SKETCHES} SELECT * FROM rel",
    "text_reuse_members": f"WITH {_SKETCHES} SELECT doc_id, representative FROM member",
    "text_reuse_clusters": f"""WITH RECURSIVE {_SKETCHES},
e AS (SELECT document_id AS a, target_document_id AS b FROM rel UNION SELECT target_document_id, document_id FROM rel),
reach AS (SELECT DISTINCT a, a AS b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
top AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT doc_id, min(doc_id) OVER (PARTITION BY coalesce(c, representative)) AS cluster_id FROM member LEFT JOIN top ON representative = a""",
    "benchmark_contamination": r"""WITH g AS (SELECT doc_id, unnest(list_distinct([array_to_string(w[i:i+7], ' ') for i in range(1, len(w) - 6)])) AS gram FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents)),
b AS (SELECT item_id, unnest(list_distinct([array_to_string(w[i:i+7], ' ') for i in range(1, len(w) - 6)])) AS gram FROM (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM benchmark)),
s AS (SELECT item_id, count(*) AS item_shingles FROM b GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS shared, any_value(item_shingles) AS item_shingles FROM g JOIN b USING (gram) JOIN s USING (item_id) GROUP BY doc_id, item_id""",
}
