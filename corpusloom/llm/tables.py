"""Queries of the training-data operators: production parameters, whole tables, the digest columns of each contract."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import attention_lm, bpe_trie, chat, media, packing, quality_rules, simhash, substring_dedup, toxicity, warc
from corpusloom.llm.common import documents

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_trie.bpe_round_trip(documents(spark, sf_dir), WORD_BPE)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(documents(spark, sf_dir))


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_report(documents(spark, sf_dir))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(spark, documents(spark, sf_dir), sf_dir)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), BYTE_BPE)


def op6_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.lm_scores(documents(spark, sf_dir), BYTE_BPE)


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_report(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(documents(spark, sf_dir))


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.text_media(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_quality": op2_quality,
    "op3_substrings": op3_substrings,
    "op4_toxicity": op4_toxicity,
    "op5_packing": op5_packing,
    "op6_lm": op6_lm,
    "op7_chat": op7_chat,
    "op8_warc": op8_warc,
    "op9_simhash": op9_simhash,
    "op10_media": op10_media,
}
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
ORACLE: dict[str, str] = {
    "op2_quality": rf"""WITH a AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM a)),
h AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1), r AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM h, range(3) t(k) GROUP BY doc_id),
b AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines, len(list_distinct(w)) AS n_distinct,
 length(regexp_replace(text, '[^A-Z]', '', 'g')) AS capitals, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS letters, length(regexp_replace(text, '[^0-9]', '', 'g')) AS digits, length(regexp_replace(text, '[^!]', '', 'g')) AS shouts FROM a LEFT JOIN r USING (doc_id)),
c AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR 100 * n_symbols > 25 * n_words OR 100 * shouts > 50 * n_words OR 100 * capitals > 60 * letters OR 100 * n_dup_lines > 60 * n_lines OR 100 * digits > 40 * word_chars OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 100 * n_distinct < 4 * n_words) AS kept FROM c""",
    "op3_substrings": rf"""WITH a AS (SELECT doc_id, {_WORDS} AS w FROM documents), s AS (SELECT doc_id, i, md5(array_to_string(w[i:i+49], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM a)),
f AS (SELECT doc_id, i FROM s QUALIFY min(doc_id) OVER (PARTITION BY h) < doc_id), g AS (SELECT doc_id, list(DISTINCT i + k) AS gone FROM f, range(50) t(k) GROUP BY doc_id),
k AS (SELECT doc_id, w, coalesce(gone, []) AS gone FROM a LEFT JOIN g USING (doc_id)), p AS (SELECT doc_id, i, w[i] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM k)),
u AS (SELECT doc_id, unnest(gone) AS i, true AS gone FROM k), q AS (SELECT doc_id, sha256(string_agg(word, ' ' ORDER BY i)) AS h FROM p LEFT JOIN u USING (doc_id, i) WHERE gone IS NULL GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(gone) AS n_removed, coalesce(h, sha256('')) AS kept_sha256 FROM k LEFT JOIN q USING (doc_id)""",
    "op8_warc": """WITH a AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
b AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM a)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to FROM b""",
}
