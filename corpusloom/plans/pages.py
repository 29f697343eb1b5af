"""Addresses and access decisions over pages; the HTML operators' queries are in plans/html.py."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import access as A
from corpusloom.functions import urls as U
from corpusloom.session import table


def pages(spark, d):
    return table(spark, d, "pages").select("page_id", "url")


def parts(spark, d):
    u = F.col("url")
    return pages(spark, d).select("page_id", U.origin(u).alias("origin"), U.host(u).alias("host"), U.part(u, 3).alias("path"), U.part(u, 4).alias("query"), U.part(u, 5).alias("fragment"))


def collapse(spark, d):
    """Loose address keys that several distinct addresses share."""
    return pages(spark, d).groupBy(U.address_key(F.col("url")).alias("key")).agg(F.count_distinct("url").alias("urls")).where("urls >= 2")


def https_candidates(spark, d):
    """Hosts seen under https alone lend their scheme to http addresses of theirs (a join on the host, not an array)."""
    p = pages(spark, d).select("page_id", "url", U.host(F.col("url")).alias("host"), F.lower(U.part(F.col("url"), 1)).alias("scheme"))
    seen = p.groupBy("host").agg(F.bool_or(F.col("scheme") == "https").alias("s"), F.bool_or((F.col("scheme") == "http") & (F.col("page_id") % 4 == 0)).alias("p")).where("s AND NOT p")
    return p.where("scheme = 'http'").join(seen, "host").select("page_id", F.concat(F.lit("https"), F.substring("url", 5, 100000)).alias("https_url"))


def qualification(spark, d):
    u = F.col("url")
    reasons = F.array_join(F.filter(F.array(F.when(U.part(u, 5) != "", "has_fragment"), F.when(U.part(u, 4).contains("utm_"), "tracking"), F.when(U.host(u).rlike(r"^(m|blog)\."), "variant_host"), F.when(U.host(u).contains("spam"), "denied_host")), lambda x: x.isNotNull()), ",")
    state = F.when(F.col("reasons").contains("denied_host"), "REJECTED").when(F.col("reasons").contains("variant_host"), "DEFERRED").otherwise("QUALIFIED")
    return pages(spark, d).withColumn("reasons", reasons).select("page_id", "reasons", state.alias("state"))


def access(spark, d):
    """Access classes and hold scopes of made-up answers, one for each page."""
    status = F.element_at(F.array(*[F.lit(x) for x in (200, 401, 403, 429, 451, 503)]), (F.col("page_id") % 6 + 1).cast("int"))
    body = F.when(F.col("page_id") % 5 == 0, "<div class='g-recaptcha'>").when(F.col("page_id") % 7 == 0, "Just a moment...").otherwise("text")
    kind = F.when(F.col("page_id") % 3 == 0, "robots_txt").when(F.col("page_id") % 3 == 1, "channel_document").otherwise("item")
    rows = pages(spark, d).select("page_id", A.response_class(status, body).alias("access"), kind.alias("kind"))
    return rows.withColumn("hold", A.hold_scope(F.col("kind"), F.col("access")))


def policy(spark, d):
    return pages(spark, d).select("page_id", A.first_refusal(("DENY", "legal_hold", F.col("page_id") % 10 == 0), ("DENY", "opted_out", U.host(F.col("url")).contains("spam")), ("DEFER", "suppressed", F.col("page_id") % 4 == 1)).alias("decision"))


def robots(spark, d):
    """Paths against a small rule table: the longest matching pattern decides, an allow wins a tie."""
    rules = spark.createDataFrame([("/", True), ("/fr/", False), ("/*/853", False), ("/en/*7$", False), ("/en/77", True)], "rule string, allow boolean").withColumn("n", F.length("rule")).withColumn("pattern", A.robots_pattern(F.col("rule")))
    paths = pages(spark, d).select("page_id", U.part(F.col("url"), 3).alias("path"))
    hit = paths.join(F.broadcast(rules), F.expr("path rlike pattern"))  # five rules
    return hit.groupBy("page_id").agg(F.max(F.struct("n", "allow"))["allow"].alias("allowed"))


def url_keys(spark, d):
    """Keys of the pages' addresses and of variants of them: markers, dots, escapes, other hosts."""
    rules = U.KeyRules(("https://example.com", "http://example.com"), ("page", ""), ("/amp",), ("/print",))
    rest = F.regexp_replace("url", r"^https?://[^/]+", "")
    form = F.pmod("page_id", F.lit(5))
    requested = F.when(form == 0, F.concat(F.lit("http://EXAMPLE.com:80/amp"), rest)).when(form == 1, F.concat(F.lit("https://example.com/x/%2e%2e"), rest)).when(form == 2, F.concat(F.lit("https://example.com/%7eñ/./print"), F.regexp_replace(rest, r"^[^?#]*", ""))).when(form == 3, F.concat(F.lit("https://other.com"), rest)).otherwise(F.concat(F.lit("https://example.com"), rest))
    made = pages(spark, d).select("page_id", U.url_key(rules, F.lit(None).cast("string"), F.when(F.col("page_id") % 7 == 0, F.lit("https://example.com/final?b&a&page=2&page=1")), requested).alias("k"))
    return made.select("page_id", "k.key", "k.basis")


_P = r"p AS (SELECT page_id, url, lower(regexp_extract(url, '^(\w+):', 1)) AS scheme, lower(regexp_extract(url, '^\w+://([^/?#:]*)', 1)) AS host, regexp_extract(url, '^\w+://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '\?([^#]*)', 1) AS query, regexp_extract(url, '#(.*)$', 1) AS fragment FROM pages)"
_PATH = "regexp_replace(url, '^https?://[^/]+', '')"
QUERIES = {
    "url_parts": parts,
    "without_tracking": lambda spark, d: pages(spark, d).select("page_id", U.without_tracking(F.col("url")).alias("url")),
    "page_flags": lambda spark, d: pages(spark, d).select("page_id", U.flags(F.col("url"), F.when(F.col("page_id") % 17 == 0, 404).otherwise(200)).alias("flags")),
    "address_keys": lambda spark, d: pages(spark, d).select("page_id", U.address_key(F.col("url")).alias("key")),
    "canonical_collapse": collapse,
    "listing_numbers": lambda spark, d: pages(spark, d).select("page_id", U.listing_number(F.col("url")).alias("number")),
    "https_for_registered": https_candidates,
    "candidate_qualification": qualification,
    "access_classes": access,
    "policy_decisions": policy,
    "robots_rules": robots,
    "allowances": lambda spark, d: table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n")).select("event_type", A.allowance(F.col("n") / 30).alias("allowance")),
    "url_keys": url_keys,
}
_FLAGS = ", ".join(f"CASE WHEN regexp_matches({_PATH}, '(?i){p}') THEN '{n}' END" for n, p in U.URL_FLAGS)
ORACLE = {
    "url_keys": rf"""WITH a AS (SELECT page_id, regexp_replace(url, '^https?://[^/]+', '') AS rest FROM pages),
b AS (SELECT page_id, regexp_extract(rest, '^([^?#]*)', 1) AS path, list_sort(list_filter(string_split(regexp_extract(rest, '\?([^#]*)', 1), '&'), lambda x: x <> '' AND (NOT contains(x, '=') OR starts_with(x, 'page=')))) AS kept FROM a),
c AS (SELECT page_id, page_id % 7 = 0 AS f, CASE page_id % 5 WHEN 3 THEN NULL WHEN 2 THEN '/~%C3%B1' ELSE CASE WHEN path = '' THEN '/' ELSE path END END AS path, array_to_string(kept, '&') AS q FROM b)
SELECT page_id, CASE WHEN f THEN 'https://example.com/final?a&b&page=1&page=2' WHEN path IS NOT NULL THEN 'https://example.com' || path || CASE WHEN q <> '' THEN '?' || q ELSE '' END END AS key, CASE WHEN f THEN 'final_url' WHEN path IS NOT NULL THEN 'requested_url' END AS basis FROM c""",
    "url_parts": f"WITH {_P} SELECT page_id, scheme || '://' || host AS origin, host, path, query, fragment FROM p",
    "without_tracking": f"WITH {_P}, q AS (SELECT *, array_to_string(list_filter(string_split(query, '&'), lambda x: NOT starts_with(x, 'utm_')), '&') AS kept FROM p) SELECT page_id, CASE WHEN contains(query, 'utm_') THEN regexp_extract(url, '^([^?#]*)', 1) || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END || regexp_extract(url, '(#.*)$', 1) ELSE url END AS url FROM q",
    "page_flags": rf"SELECT page_id, CASE WHEN page_id % 17 = 0 THEN 'not_a_2xx_answer' ELSE array_to_string(list_filter([{_FLAGS}, CASE WHEN trim({_PATH}, '/') = '' OR (length({_PATH}) - length(replace({_PATH}, '/', '')) <= 1 AND NOT regexp_matches({_PATH}, '\d|-.*-')) THEN 'front_or_top_level_page_url' END], lambda x: x IS NOT NULL), ',') END AS flags FROM pages",
    "address_keys": f"WITH {_P} SELECT page_id, regexp_replace(host, '^www[.]', '') || rtrim(path, '/') AS key FROM p",
    "canonical_collapse": f"WITH {_P} SELECT regexp_replace(host, '^www[.]', '') || rtrim(path, '/') AS key, count(DISTINCT url) AS urls FROM p GROUP BY 1 HAVING count(DISTINCT url) >= 2",
    "listing_numbers": r"SELECT page_id, coalesce(nullif(regexp_extract(url, '[?&](?:page|pagina|p)=(\d+)', 1), ''), nullif(regexp_extract(url, '/(?:page|pagina)/(\d+)', 1), ''))::BIGINT AS number FROM pages",
    "https_for_registered": f"WITH {_P}, s AS (SELECT host FROM p GROUP BY 1 HAVING bool_or(scheme = 'https') AND NOT bool_or(scheme = 'http' AND page_id % 4 = 0)) SELECT page_id, 'https' || url[5:] AS https_url FROM p JOIN s USING (host) WHERE scheme = 'http'",
    "candidate_qualification": f"WITH {_P}, r AS (SELECT page_id, array_to_string(list_filter([CASE WHEN fragment <> '' THEN 'has_fragment' END, CASE WHEN contains(query, 'utm_') THEN 'tracking' END, CASE WHEN regexp_matches(host, '^(m|blog)[.]') THEN 'variant_host' END, CASE WHEN contains(host, 'spam') THEN 'denied_host' END], lambda x: x IS NOT NULL), ',') AS reasons FROM p) SELECT *, CASE WHEN contains(reasons, 'denied_host') THEN 'REJECTED' WHEN contains(reasons, 'variant_host') THEN 'DEFERRED' ELSE 'QUALIFIED' END AS state FROM r",
    "access_classes": "WITH a AS (SELECT page_id, [200, 401, 403, 429, 451, 503][page_id % 6 + 1] AS st, CASE page_id % 3 WHEN 0 THEN 'robots_txt' WHEN 1 THEN 'channel_document' ELSE 'item' END AS kind FROM pages), b AS (SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'captcha' WHEN page_id % 7 = 0 THEN 'bot_challenge' WHEN st = 401 THEN 'auth_required' WHEN st = 403 THEN 'forbidden' WHEN st = 451 THEN 'unavailable_for_legal_reasons' WHEN st = 429 THEN 'rate_limited' ELSE 'none_observed' END AS access, kind FROM a) SELECT *, CASE WHEN access = 'none_observed' THEN NULL WHEN access = 'rate_limited' THEN 'origin' WHEN kind = 'robots_txt' THEN CASE WHEN access IN ('captcha', 'bot_challenge', 'unavailable_for_legal_reasons') THEN 'origin' END WHEN kind = 'channel_document' THEN 'url' ELSE 'origin' END AS hold FROM b",
    "policy_decisions": f"WITH {_P} SELECT page_id, CASE WHEN page_id % 10 = 0 THEN 'DENY:legal_hold' WHEN contains(host, 'spam') THEN 'DENY:opted_out' WHEN page_id % 4 = 1 THEN 'DEFER:suppressed' ELSE 'ALLOW' END AS decision FROM p",
    "robots_rules": f"WITH {_P}, r AS (SELECT unnest([1, 4, 6, 7, 6]) AS n, unnest([true, false, false, false, true]) AS allow, unnest(['^/', '^/fr/', '^/.*/853', '^/en/.*7$', '^/en/77']) AS pat) SELECT page_id, arg_max(allow, (n, allow)) AS allowed FROM p JOIN r ON regexp_matches(path, pat) GROUP BY 1",
    "allowances": "SELECT event_type, least(30, greatest(3, ceil(1.5 * (count(*) / 30::DOUBLE) / 24)))::BIGINT AS allowance FROM events GROUP BY 1",
}
