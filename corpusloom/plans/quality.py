"""Text measures and gate decisions over documents; labels as the gold they are scored against."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import quality
from corpusloom.functions import text as T
from corpusloom.functions.text import FUNCTION_WORDS_ES
from corpusloom.operators.estimate import wilson
from corpusloom.session import spread, table

#: Thresholds for the driver's corpus, most of which is not Spanish: no share of function words is asked for.
RULES = quality.RuleSet("gate/4-any-language", min_words=50, min_function_share=0.0)


def _features(spark, d):
    return quality.features(spread(table(spark, d, "documents")), "doc_id", "source", "lang")


def _decisions(spark, d):
    return quality.decide(_features(spark, d), RULES, outlet="source", page="doc_id", order="doc_id")


def _page_known(spark, d):
    """Documents as pages: addresses, titles and stated lengths made from their columns, the gate's own thresholds."""
    docs = table(spark, d, "documents")
    shown = F.element_at(F.array(*[F.lit(x) for x in PATHS]), (F.pmod("doc_id", F.lit(len(PATHS))) + 1).cast("int"))
    page = docs.select("doc_id", F.concat(F.lit("https://"), F.coalesce("source", F.lit("x")), shown, F.col("doc_id").cast("string")).alias("url"), F.when(F.col("doc_id") % 17 == 0, "EN VIVO | algo").otherwise("algo").alias("title"), (F.coalesce("n_chars", F.lit(0)) * (F.col("doc_id") % 4)).cast("long").alias("stated"))
    return _features(spark, d).join(page, "doc_id")


#: Address paths by id: plain, live, sponsored, about the publication.
PATHS = ("/nota/", "/en-vivo/", "/nota/", "/zona-comercial/", "/nota/", "/faq/", "/nota/")


def gate_by_version(spark, d):
    """Reasons of the three rule sets side by side."""
    rows = _page_known(spark, d)
    known = quality.Page(url=F.col("url"), title=F.col("title"), stated_characters=F.col("stated"), stated_text_characters=F.floor(F.col("stated") / 2), live_blog=F.col("doc_id") % 23 == 0)
    return rows.select("doc_id", *[T.joined_reasons(*quality.page_reasons(r, known)).alias(f"reasons_{r.name[-1]}") for r in (quality.RULES_2, quality.RULES_3, quality.RULES_4)])


def body_states(spark, d):
    """Contamination states of documents whose lines are blocks; the selection is by line number, every eleventh line recurs."""
    docs = spread(table(spark, d, "documents")).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    lines = docs.select(F.col("doc_id").alias("page_id"), F.posexplode(F.split("text", "\n")).alias("i", "text"))
    picked = F.when(F.col("page_id") % 3 == 0, F.when(F.col("i") % 4 == 1, "excluded").when(F.col("i") % 4 == 2, "included"))
    blocks = lines.withColumn("selection", picked).withColumn("body", ~F.col("selection").eqNullSafe("excluded")).withColumn("kind", F.when(F.col("i") == 0, "heading").otherwise("paragraph"))
    again = lines.where(F.col("page_id") % 11 == 0).where(F.length("text") >= 200).select(F.sha2(F.lower(T.canonical(T.composed(F.col("text")))), 256).alias("digest"))
    measured = _page_known(spark, d).select(F.col("doc_id").alias("page_id"), F.lit(1.0).alias("function_word_share"), "characters", "stated")
    return quality.contamination(blocks, measured, again)


def gate_decisions(spark, d):
    return _decisions(spark, d).select("doc_id", "decision", "reasons")


def gate_confusion(spark, d):
    rows = _decisions(spark, d).join(table(spark, d, "labels"), "doc_id")
    return rows.groupBy("quality", "decision").agg(F.count("*").alias("n"))


def gate_precision(spark, d):
    rows = _decisions(spark, d).join(table(spark, d, "labels"), "doc_id").where("decision = 'ACCEPT'")
    k = rows.groupBy("lang").agg(F.sum("quality").cast("long").alias("k"), F.count("*").alias("n"))
    low, high = wilson(F.col("k"), F.col("n"))
    return k.select("lang", "k", "n", F.floor(low * 10000 + 0.5).alias("low_1e4"), F.floor(high * 10000 + 0.5).alias("high_1e4"))


def language_measures(spark, d):
    return _features(spark, d).groupBy("lang").agg(F.count("*").alias("documents"), F.sum("words").alias("words"), F.max("longest_block").alias("longest_block"), F.count_if(F.col("distinct_5gram_ratio") < 0.8).alias("repetitive"))


_WORDS = ", ".join(f"'{w}'" for w in FUNCTION_WORDS_ES)
_INVISIBLE = r"regexp_replace({0}, '[\x{{00AD}}\x{{200B}}\x{{200C}}\x{{200D}}\x{{2060}}\x{{FEFF}}]', '', 'g')"
_CANON = r"lower(trim(regexp_replace(regexp_replace(nfc_normalize({0}), '[\x{{00AD}}\x{{200B}}\x{{200C}}\x{{200D}}\x{{2060}}\x{{FEFF}}]', '', 'g'), '[\s\x{{00A0}}]+', ' ', 'g')))"
_F = rf"""
z AS (SELECT doc_id, source, lang, n_chars, {_INVISIBLE.format("coalesce(text, '')")} AS text FROM documents),
a AS (SELECT doc_id, source, lang, n_chars, text, regexp_extract_all(lower(text), '\p{{L}}+') AS w, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS blocks FROM z),
b AS (SELECT *, CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i+4], ' ') for i in range(1, len(w) - 3)] ELSE [] END AS grams, [{_CANON.format('x')} for x in blocks] AS norm, [len(regexp_extract_all(x, '\p{{L}}+')) for x in blocks] AS block_words FROM a),
f AS (SELECT doc_id, source, lang, len(w) AS words, len(list_distinct(w)) AS distinct_words, len(blocks) AS blocks, len([k for k in block_words if k >= 25]) AS long_blocks, coalesce(list_max(block_words), 0) AS longest_block,
 round_even(CASE WHEN len(blocks) > 0 THEN coalesce(list_sum(block_words), 0)::DOUBLE / len(blocks) ELSE 0.0::DOUBLE END, 1) AS mean_block_words,
 round_even(CASE WHEN len(grams) > 0 THEN len(list_distinct(grams))::DOUBLE / len(grams) ELSE 1.0::DOUBLE END, 3) AS distinct_5gram_ratio,
 round_even(CASE WHEN list_sum([length(x) for x in norm]) > 0 THEN coalesce((SELECT sum(l * n) FROM (SELECT length(x) AS l, count(*) AS n FROM (SELECT unnest(norm) AS x) WHERE length(x) >= 20 GROUP BY x HAVING count(*) > 1)), 0)::DOUBLE / list_sum([length(x) for x in norm]) ELSE 0.0::DOUBLE END, 3) AS repeated_share,
 round_even(CASE WHEN len([k for k in block_words if k >= 5]) > 0 THEN len([x for x in blocks if len(regexp_extract_all(x, '\p{{L}}+')) >= 5 AND regexp_matches(x, '[.!?…:;»"”’)\]]\s*$')])::DOUBLE / len([k for k in block_words if k >= 5]) ELSE 0.0::DOUBLE END, 3) AS sentence_end_share,
 round_even(CASE WHEN len(w) > 0 THEN len([x for x in w if x IN ({_WORDS})])::DOUBLE / len(w) ELSE 0.0::DOUBLE END, 3) AS function_word_share,
 round_even(CASE WHEN length(regexp_replace(text, '\s', '', 'g')) > 0 THEN length(regexp_replace(text, '[^\p{{L}}]', '', 'g'))::DOUBLE / length(regexp_replace(text, '\s', '', 'g')) ELSE 0.0::DOUBLE END, 3) AS letter_share,
 round_even(CASE WHEN len(blocks) > 0 THEN len([x for x in blocks if regexp_matches(x, '(?i){quality.TIME_LED.replace("'", "''")}') AND NOT regexp_matches(x, '{quality.PLAYER_ZERO}')])::DOUBLE / len(blocks) ELSE 0.0::DOUBLE END, 3) AS time_led_share,
 len(regexp_extract_all(text, '(?i){quality.BOILERPLATE}')) AS boilerplate_hits, length(text) AS characters,
 len(regexp_extract_all(text, '(?i){quality.FRAME}')) AS frame_hits, len(regexp_extract_all(text, '(?i){quality.PAYWALL}')) AS paywall_hits, len(regexp_extract_all(text, '(?i){quality.MACHINE}')) AS machine_hits,
 len([x for x in blocks if regexp_matches(x, '(?i){quality.SPONSORED}')]) AS sponsored_hits, sha256({_CANON.format('text')}) AS body_sha256 FROM b)
"""
_D = f"""{_F}, g AS (SELECT *, count(*) FILTER (words > 0) OVER (PARTITION BY source, body_sha256) AS copies, row_number() OVER (PARTITION BY source, body_sha256 ORDER BY doc_id) AS rank FROM f),
d AS (SELECT *, array_to_string(list_filter([CASE WHEN words = 0 THEN 'no_body' END, CASE WHEN words > 0 AND words < 50 THEN 'too_short' END, CASE WHEN frame_hits > 0 THEN 'page_frame' END, CASE WHEN paywall_hits > 0 THEN 'paywall_text' END, CASE WHEN sponsored_hits > 0 THEN 'sponsored' END, CASE WHEN time_led_share > 0.2 THEN 'live_coverage' END,
 CASE WHEN words > 0 AND (distinct_5gram_ratio < 0.8 OR repeated_share > 0.3) THEN 'repetitive' END, CASE WHEN words > 0 AND copies >= 3 THEN 'template_body' END, CASE WHEN words > 0 AND copies < 3 AND rank > 1 THEN 'duplicate_of_earlier' END], lambda x: x IS NOT NULL), ',') AS reasons FROM g),
e AS (SELECT *, CASE WHEN reasons = '' THEN 'ACCEPT' ELSE 'REJECT' END AS decision FROM d)"""

_P = rf"""{_F}, u AS (SELECT f.*, 'https://' || coalesce(f.source, 'x') || ({list(PATHS)})[1 + doc_id % {len(PATHS)}] || doc_id AS url, CASE WHEN doc_id % 17 = 0 THEN 'EN VIVO | algo' ELSE 'algo' END AS title, coalesce(n_chars, 0) * (doc_id % 4) AS stated FROM f JOIN (SELECT doc_id, n_chars FROM z) USING (doc_id)),
r AS (SELECT doc_id, characters, stated, words = 0 AS c0, words BETWEEN 1 AND 149 AS c1, words > 0 AND function_word_share < 0.3 AS c2, frame_hits > 0 AS c3, paywall_hits > 0 AS c4, machine_hits > 0 AS c5, sponsored_hits > 0 OR regexp_matches(url, '(?i){quality.SPONSORED_URL}') AS c6,
 time_led_share > 0.2 OR regexp_matches(url, '(?i){quality.LIVE_URL}') OR regexp_matches(title, '(?i){quality.LIVE_TITLE}') AS c7, doc_id % 23 = 0 AS c8, regexp_matches(url, '(?i){quality.NOT_EDITORIAL_URL}') AS c9,
 stated >= 1000 AND characters < 0.5 * stated AS ca, stated // 2 >= 1000 AND characters < 0.5 * (stated // 2) AS cb, words > 0 AND (distinct_5gram_ratio < 0.8 OR repeated_share > 0.3) AS cc FROM u)"""


def _version(machine: str, live: str, stated: str) -> str:
    names = {"no_body": "c0", "too_short": "c1", "not_running_prose": "c2", "page_frame": "c3", "paywall_text": "c4", "machine_text": machine, "sponsored": "c6", "live_coverage": live, "not_editorial_page": "c9", "incomplete_against_stated_body": stated, "repetitive": "cc"}
    return "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in names.items()) + "], lambda x: x IS NOT NULL), ',')"


_STATES = rf"""{_F}, l AS (SELECT doc_id AS page_id, unnest(string_split(coalesce(text, ''), chr(10))) AS text, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS i FROM documents),
s AS (SELECT *, CASE WHEN page_id % 3 = 0 THEN CASE WHEN i % 4 = 1 THEN 'excluded' WHEN i % 4 = 2 THEN 'included' END END AS selection, len(regexp_extract_all(text, '\S+')) AS said, sha256({_CANON.format('text')}) AS digest FROM l),
b2 AS (SELECT *, selection IS DISTINCT FROM 'excluded' AS body, CASE WHEN selection IS NULL THEN true ELSE selection = 'excluded' END AS before, digest IN (SELECT digest FROM s WHERE page_id % 11 = 0 AND length(text) >= 200) AS recurs FROM s),
p AS (SELECT page_id, coalesce(sum(said) FILTER (body), 0)::BIGINT AS words, coalesce(sum(said) FILTER (before), 0)::BIGINT AS words_before, count(selection) AS selected, count(*) FILTER (body AND regexp_matches(text, '(?i){quality.ADDRESS}')) AS addresses, count(*) FILTER (body AND regexp_matches(text, '(?i){quality.CREDIT_OPENING}')) AS credits,
 count(*) FILTER (body AND recurs) AS recurring, count(*) FILTER (body AND i > 0 AND said <= 3 AND NOT regexp_matches(text, '[.!?…:;»”")]\s*$')) AS labels FROM b2 GROUP BY page_id),
m AS (SELECT doc_id AS page_id, characters, coalesce(n_chars, 0) * (doc_id % 4) AS stated FROM f JOIN (SELECT doc_id, n_chars FROM z) USING (doc_id)),
q AS (SELECT *, array_to_string(list_filter([CASE WHEN addresses > 0 THEN 'address_or_path' END, CASE WHEN credits > 0 THEN 'credit_opening' END, CASE WHEN recurring > 0 THEN 'recurring_text' END, CASE WHEN labels >= 3 THEN 'label_blocks' END], lambda x: x IS NOT NULL), ',') AS signals FROM p JOIN m USING (page_id))
SELECT page_id, CASE WHEN words = 0 OR (words_before >= 50 AND words <= (1 - 0.9::DOUBLE) * words_before) THEN 'not_article' WHEN stated >= 1000 AND characters < 0.5 * stated THEN 'incomplete' WHEN signals <> '' THEN 'residual_suspect' WHEN selected > 0 THEN 'cleaned' ELSE 'clean' END AS state, signals, words, words_before FROM q"""

QUERIES = {
    "gate_by_version": gate_by_version,
    "body_states": body_states,
    "text_features": _features,
    "gate_decisions": gate_decisions,
    "gate_confusion": gate_confusion,
    "gate_precision": gate_precision,
    "language_measures": language_measures,
}
ORACLE = {
    "gate_by_version": f"WITH {_P} SELECT doc_id, {_version('c5', 'c7', 'ca')} AS reasons_2, {_version('false', 'c7', 'ca')} AS reasons_3, {_version('false', '(c7 OR c8)', 'cb')} AS reasons_4 FROM r",
    "body_states": f"WITH {_STATES}",
    "text_features": f"WITH {_F} SELECT * FROM f",
    "gate_decisions": f"WITH {_D} SELECT doc_id, decision, reasons FROM e",
    "gate_confusion": f"WITH {_D} SELECT quality, decision, count(*) AS n FROM e JOIN labels USING (doc_id) GROUP BY ALL",
    "gate_precision": f"""WITH {_D}, k AS (SELECT lang, sum(quality)::BIGINT AS k, count(*) AS n FROM e JOIN labels USING (doc_id) WHERE decision = 'ACCEPT' GROUP BY lang),
c AS (SELECT *, k::DOUBLE / n AS p, 1.959964 AS z FROM k),
i AS (SELECT *, (p + z * z / (2 * n)) / (1 + z * z / n) AS mid, z * sqrt(greatest(0.0, p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n) AS half FROM c)
SELECT lang, k, n, floor(greatest(0.0, mid - half) * 10000 + 0.5)::BIGINT AS low_1e4, floor(least(1.0, mid + half) * 10000 + 0.5)::BIGINT AS high_1e4 FROM i""",
    "language_measures": f"WITH {_F} SELECT lang, count(*) AS documents, sum(words) AS words, max(longest_block) AS longest_block, count(*) FILTER (distinct_5gram_ratio < 0.8) AS repetitive FROM f GROUP BY lang",
}
