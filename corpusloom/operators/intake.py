"""What an intake lists, reads, spends and labels: channel coverage, frontiers, orders of requests, budgets, holds, admission.

Shapes. inputs (channel documents that were asked for): channel_id, run_id, input_id, document_url, final_url, outcome, depth.
listed (entries of channel documents): event_id, channel_id, run_id, input_id, position, relation (item, child_document,
next_page), resolved_url, candidate_id, problem, at (seconds, or null), lastmod. Everything is an aggregation or an
equi-join; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = "candidate_budget_exhausted"
# Sizes of channels, types that are read as HTML, how an HTML document begins, names of child documents.
LARGE_SITEMAP_ENTRIES, BULK_ENTRIES = 500, 5000
HTML_TYPES = ("text/html", "application/xhtml+xml")
HTML_START = r"^\s*(?:<!--.*?-->\s*)*<(?:!doctype\s+html|html[\s>])"
LATE_CHILD = (
    r"(?:^|[^a-z0-9])(?:category|categories|categoria|categorias|tag|tags|post_tag|etiqueta|etiquetas|"
    r"author|authors|autor|autores|page|pages|pagina|paginas|attachment|image|images|video|videos)(?:[^a-z0-9]|$)"
)
EARLY_CHILD = r"(?:^|[^a-z0-9])(?:news|noticias)(?:[^a-z0-9]|$)"
#: Offsets of the zone names that mail dates use.
ZONES = {"UT": "+0000", "UTC": "+0000", "GMT": "+0000", "Z": "+0000", "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500", "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700"}


def hint_instant(text: Column) -> Column:
    """A stated date as a timestamp: ISO 8601 (a day is its midnight) or the form of mail headers; without an offset it is UTC."""
    plain = F.trim(text)
    iso = F.when(plain.rlike(r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:[.,]\d{1,6})?)?\s*(?:Z|[+-]\d{2}:?\d{2})?)?$"), F.regexp_replace(F.regexp_replace(F.regexp_replace(plain, ",", "."), r"\s*([+-]\d{2}):?(\d{2})$", "$1:$2"), r"^(\d{4}-\d{2}-\d{2}) ", "$1T"))
    iso = F.regexp_replace(iso, r"^(.{10}T\d{2}:\d{2})(?=$|Z|[+-])", "$1:00")
    zoned = F.when(iso.rlike(r"(?:Z|[+-]\d{2}:\d{2})$"), iso).when(F.length(iso) == 10, F.concat(iso, F.lit("T00:00:00Z"))).otherwise(F.concat(iso, F.lit("Z")))
    mail = F.regexp_replace(plain, r"^(?:[A-Za-z]{3},\s*)?", "")
    zone = F.regexp_extract(mail, r"\s([A-Za-z]{1,3}|[+-]\d{4})$", 1)
    named = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in ZONES.items() for x in kv]), F.upper(zone)), F.when(zone.rlike(r"^[+-]\d{4}$"), zone), F.lit("+0000"))
    head = F.regexp_extract(mail, r"^(\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2})(?::\d{2})?", 1)
    seconds = F.coalesce(F.nullif(F.regexp_extract(mail, r"^\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:(\d{2})", 1), F.lit("")), F.lit("00"))
    return F.coalesce(F.try_to_timestamp(zoned), F.when(head != "", F.try_to_timestamp(F.concat(head, F.lit(":"), seconds, F.lit(" "), named), F.lit("d MMM yyyy HH:mm:ss Z"))))


def entry_instant(published: Column, updated: Column, lastmod: Column) -> Column:
    """When a channel says an entry is from."""
    return F.coalesce(hint_instant(published), hint_instant(updated), hint_instant(lastmod))


def retry_after(value: Column, now: Column) -> Column:
    """Seconds that an answer asks to wait: a number, or the time until a date, not below zero; null if unusable. now: a timestamp."""
    plain = F.trim(value)
    until = hint_instant(F.when(~plain.rlike(r"^\d{4}-"), plain))
    return F.when(plain.rlike(r"^\d+$"), plain.cast("double")).when(until.isNotNull(), F.greatest(F.lit(0.0), (F.unix_micros(until) - F.unix_micros(now)) / 1e6))


def refusal(body: Column, content_type: Column) -> Column:
    """Why a body is not read as HTML, or null. body: text; content_type: without parameters, 'unknown' where none is stated."""
    start = F.regexp_replace(F.left(body, F.lit(2048)), "^﻿", "")
    return (
        F.when(F.coalesce(F.length(body), F.lit(0)) == 0, "empty_body").when(content_type.isin(*HTML_TYPES), None)
        .when(content_type == "unknown", F.when(start.rlike(f"(?is){HTML_START}"), None).otherwise("not_html")).otherwise("unsupported_content_type")
    )


def channel_class(kind: Column, formats: Column, entries: Column) -> Column:
    """How a channel is polled. formats: array of what it was read as; entries: what it listed last."""
    n, has = F.coalesce(entries, F.lit(0)), lambda f: F.array_contains(formats, f)
    return (
        F.when(n > BULK_ENTRIES, "bulk").when(has("html_listing") | kind.isin("section_page", "archive"), "listing").when(has("sitemap_index") | (kind == "sitemap_index"), "sitemap_index")
        .when(has("sitemap_urlset") | (kind == "sitemap"), F.when(n > LARGE_SITEMAP_ENTRIES, "large_sitemap").otherwise("sitemap")).otherwise("feed")
    )


def read_documents(inputs: DataFrame) -> DataFrame:
    """channel_id and url of channel documents that were read, as asked for and as they came."""
    answered = inputs.where("outcome <> 'unavailable'")
    return answered.select("channel_id", F.explode(F.array("document_url", F.coalesce("final_url", "document_url"))).alias("url")).distinct()


def coverage(inputs: DataFrame, listed: DataFrame, first_events: DataFrame) -> DataFrame:
    """Per channel: what it listed, kept, turned away, named and did not read. first_events: candidate_id, event_id (that which made it)."""
    item, kept, dropped = F.col("relation") == "item", F.col("candidate_id").isNotNull(), F.col("problem").eqNullSafe(F.lit(BUDGET))
    made = first_events.select("event_id").distinct().withColumn("made", F.lit(True))
    rows = listed.join(made, "event_id", "left").withColumn("newly", kept & item & F.col("made").isNotNull())
    counts = rows.groupBy("channel_id").agg(
        F.count_if(item).alias("items"), F.count_if(item & kept).alias("items_kept"), F.count_distinct(F.when(item & kept, F.col("candidate_id"))).alias("candidates"), F.count_if(item & dropped).alias("items_dropped"),
        F.count_if("newly").alias("items_new"), F.min(F.when(item & kept, F.col("at"))).alias("kept_from"), F.max(F.when(item & kept, F.col("at"))).alias("kept_to"), F.min(F.when(F.col("newly"), F.col("at"))).alias("new_from"),
    )
    late = rows.where(item & dropped & F.col("at").isNotNull()).join(counts.select("channel_id", "kept_from", "new_from"), "channel_id").groupBy("channel_id").agg(F.count_if(F.col("at") > F.col("kept_from")).alias("over_kept"), F.count_if(F.col("at") > F.col("new_from")).alias("over_new"))
    named = listed.where(F.col("relation").isin("child_document", "next_page") & F.col("resolved_url").isNotNull()).select("channel_id", F.col("resolved_url").alias("url")).distinct()
    unread = named.join(read_documents(inputs).withColumn("read", F.lit(True)), ["channel_id", "url"], "left").groupBy("channel_id").agg(F.count("*").alias("documents_named"), F.count_if(F.col("read").isNull()).alias("documents_unread"))
    outcomes = inputs.groupBy("channel_id").agg(F.count("*").alias("documents"), F.count_if(F.col("outcome") == "parsed").alias("documents_parsed"))
    out = counts.join(outcomes, "channel_id", "full_outer").join(unread, "channel_id", "left").join(late, "channel_id", "left")
    whole = ("items", "items_kept", "candidates", "items_dropped", "items_new", "documents", "documents_parsed", "documents_named", "documents_unread")
    # a comparison needs dates on both sides
    return out.select("channel_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in whole], "kept_from", "kept_to", F.when(F.col("kept_from").isNotNull(), F.col("over_kept")).alias("dropped_newer_than_kept"), F.when(F.col("new_from").isNotNull(), F.col("over_new")).alias("dropped_newer_than_new"))


def priority(url: Column, at: Column) -> list[Column]:
    """Order in which named documents are read: news by name first, taxonomies and media last; then the latest, undated ones last."""
    name = F.lower(F.regexp_extract(url, r"([^/?#]*)(?:[?#].*)?$", 1))
    rank = F.when(name.rlike(EARLY_CHILD), 0).when(name.rlike(LATE_CHILD), 2).otherwise(1)
    return [rank, at.isNull().cast("int"), F.coalesce(-at, F.lit(0))]


def frontier(inputs: DataFrame, listed: DataFrame) -> DataFrame:
    """Documents that a channel names and no pass has read, with the latest statement about each and its place in the reading order."""
    read = read_documents(inputs).withColumnRenamed("url", "resolved_url")
    children = listed.where("relation = 'child_document' and resolved_url is not null").join(read, ["channel_id", "resolved_url"], "left_anti")
    last = children.groupBy("channel_id", "resolved_url").agg(F.max_by(F.struct("position", "lastmod", "at"), "event_id").alias("s")).select("channel_id", "resolved_url", "s.*")
    keys = priority(F.col("resolved_url"), F.col("at"))
    w = Window.partitionBy("channel_id").orderBy(*keys, "position", "resolved_url")
    return last.select("channel_id", "resolved_url", "lastmod", keys[0].alias("class"), F.row_number().over(w).alias("place"))


def read_unchanged(inputs: DataFrame, listed: DataFrame, before_run: int | None = None) -> DataFrame:
    """Children that an earlier pass read whole, with the lastmod stated when it did: parsed, and no entry turned away by a budget."""
    cut = listed.where(F.col("problem") == BUDGET).select("channel_id", "input_id").distinct()
    earlier = inputs.where("outcome = 'parsed' and depth > 0")
    whole = earlier.where(~F.col("run_id").eqNullSafe(F.lit(before_run)) if before_run is not None else F.lit(True)).join(cut, ["channel_id", "input_id"], "left_anti").select("channel_id", "run_id", F.col("document_url").alias("resolved_url")).distinct()
    stated = listed.where("relation = 'child_document'").where(F.trim(F.coalesce(F.col("lastmod").cast("string"), F.lit(""))) != "")
    return stated.join(whole, ["channel_id", "run_id", "resolved_url"]).groupBy("channel_id", "resolved_url").agg(F.max_by("lastmod", "event_id").alias("lastmod"))


def intake_order(due: DataFrame, backlog: int) -> DataFrame:
    """Requests of a cycle, in order: new in the window, the latest first; new and undated, the last listed first; at most
    `backlog` of the rest. due: candidate_id, class (novelty), published, first_listed."""
    rank = F.when(F.col("class") == "new_dated_in_window", 0).when(F.col("class") == "new_undated_later_poll", 1).otherwise(2)
    back = Window.partitionBy("rank").orderBy(F.coalesce("published", F.lit(0)).desc(), F.col("first_listed").desc(), F.col("candidate_id").desc())
    rest = due.withColumn("rank", rank).where("rank = 2").orderBy(F.coalesce("published", F.lit(0)).desc(), F.col("first_listed").desc(), F.col("candidate_id").desc()).limit(backlog)  # a top-k of each partition
    rows = rest.withColumn("k", F.row_number().over(back)).unionByName(due.withColumn("rank", rank).where("rank < 2").withColumn("k", F.lit(0)))
    return rows.orderBy("rank", "k", F.when(F.col("rank") == 0, -F.col("published")), F.when(F.col("rank") == 1, -F.col("first_listed")), F.when(F.col("rank") == 1, -F.col("candidate_id")), "candidate_id").select("candidate_id", "class", "rank")


def qualification_order(due: DataFrame, listed: DataFrame, run_id: int) -> DataFrame:
    """Sort keys of a sample of current pages: this run's dated ones, the latest first; its undated ones as listed; the rest, the
    last listed first. due: candidate_id, first_listed."""
    here = listed.where((F.col("run_id") == run_id) & F.col("candidate_id").isNotNull()).groupBy("candidate_id").agg(F.max("at").alias("at"), F.min("event_id").alias("first"))
    rows = due.join(here, "candidate_id", "left")
    rank = F.when(F.col("at").isNotNull(), 0).when(F.col("first").isNotNull(), 1).otherwise(2)
    key = F.when(F.col("at").isNotNull(), -F.col("at")).when(F.col("first").isNotNull(), F.col("first")).otherwise(-F.col("first_listed"))
    return rows.select("candidate_id", rank.alias("rank"), key.alias("key"), F.when(rank == 2, -F.col("candidate_id")).otherwise(F.col("candidate_id")).alias("tie"))


def pending_refusal(packs: DataFrame, now: int, most: int, most_bytes: int, most_hours: int) -> DataFrame:
    """One row: packs, bytes and age of the oldest that wait, and why nothing more may be asked, or null. packs: bytes (null: unreadable), sealed (seconds)."""
    one = packs.agg(F.count("*").alias("packs"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.count_if(F.col("bytes").isNull()).alias("unreadable"), F.coalesce(F.lit(now) - F.min("sealed"), F.lit(0)).alias("age"))
    return one.withColumn("refusal", F.when(F.col("packs") > most, "too_many").when(F.col("unreadable") > 0, "unreadable").when(F.col("bytes") > most_bytes, "too_large").when(F.col("age") > most_hours * 3600, "too_old"))


def superseded(fetches: DataFrame) -> DataFrame:
    """fetch_id and whether a later attempt of its request exists. fetches: fetch_id, request_id (null: of none), attempt."""
    most = F.max("attempt").over(Window.partitionBy("request_id"))
    return fetches.select("fetch_id", (F.col("request_id").isNotNull() & (F.col("attempt") < most)).alias("superseded"))


# Reasons of the technical label that make an item unusable, in the order in which they are looked at.
BLOCKING = ("not_modified_answer", "http_redirect_answer", "http_error_status", "http_status_other", "no_document", "not_extractable", "no_body_text")


def admission(items: DataFrame) -> DataFrame:
    """fetch_id, technical_status, blocking and informing reasons, each joined in order.

    items, one row each: fetch_id, status, superseded, identity, extraction (extracted, not_extractable or null), body_characters,
    has_title, has_date, has_author, has_section, has_language (boolean), replaced (characters), duplicate_of, moved_from, lifecycle.
    """
    s, read, done = F.col("status"), F.col("extraction").isNotNull(), F.col("extraction") == "extracted"
    tests = (
        ("not_modified_answer", s == 304), ("http_redirect_answer", s.between(300, 399) & (s != 304)), ("http_error_status", s >= 400), ("http_status_other", (s < 200) | s.isin(204, 205)),
        ("superseded_attempt", F.col("superseded")), ("no_document", ~F.col("identity").eqNullSafe(F.lit("assigned"))), ("not_extractable", read & ~done), ("no_body_text", done & (F.col("body_characters") == 0)),
        ("no_title", done & ~F.col("has_title")), ("publication_date_unknown", done & ~F.col("has_date")), ("author_unknown", done & ~F.col("has_author")), ("section_unknown", done & ~F.col("has_section")),
        ("language_undeclared", done & ~F.col("has_language")), ("decoding_replaced_characters", done & (F.col("replaced") > 0)), ("duplicate_body_of_other_document", F.col("duplicate_of").isNotNull()),
        ("moved_from_other_document", F.col("moved_from").isNotNull()), ("extractor_not_active", read & ~F.col("lifecycle").eqNullSafe(F.lit("active"))),
    )
    pick = lambda blocks: F.array_join(F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in tests if (n in BLOCKING) == blocks]), lambda x: x.isNotNull()), ",")
    return items.select("fetch_id", pick(True).alias("blocking"), pick(False).alias("informing")).withColumn("technical_status", F.when(F.col("blocking") == "", "TECHNICALLY_USABLE").otherwise("TECHNICALLY_UNUSABLE"))


def moved_to(observations: DataFrame) -> DataFrame:
    """Documents whose key another document was asked for under: from, to. observations: outlet, document_id, url_key, basis, requested_key."""
    own = observations.select("outlet", F.col("url_key").alias("requested_key"), F.col("document_id").alias("from")).distinct()
    asked = observations.where("basis not in ('requested_url', 'revalidation') and requested_key is not null").select("outlet", "requested_key", F.col("document_id").alias("to")).distinct()
    return asked.join(own, ["outlet", "requested_key"]).where("`from` <> `to`").select("from", "to").distinct()


def spent(fetches: DataFrame, now: int) -> DataFrame:
    """Real requests of each outlet: all, those of items, and those of items in the last hour; redirects count. fetches: outlet, kind, at, redirects."""
    calls, item = F.lit(1) + F.col("redirects"), F.col("kind") == "item"
    return fetches.groupBy("outlet").agg(F.sum(calls).alias("requests"), F.coalesce(F.sum(F.when(item, calls)), F.lit(0)).alias("item_requests"), F.coalesce(F.sum(F.when(item & (F.col("at") > now - 3600), calls)), F.lit(0)).alias("last_hour"))


def requests_by_group(fetches: DataFrame, plans: DataFrame) -> DataFrame:
    """Real requests by outlet and group: items, or channel documents by the depth that was planned. plans: request_id, depth."""
    depth = F.coalesce("depth", F.lit(0))
    group = F.when(F.col("kind") == "channel_document", F.concat(F.lit("channel_document:"), depth.cast("string"))).otherwise(F.col("kind"))
    return fetches.join(plans, "request_id", "left").groupBy("outlet", group.alias("group")).agg(F.sum(F.lit(1) + F.col("redirects")).alias("requests"))


def observed_holds(fetches: DataFrame) -> DataFrame:
    """The first access control seen of each origin or address, by its scope. fetches: seq, scope (origin, url or null), origin, url, access."""
    key = F.when(F.col("scope") == "origin", F.col("origin")).when(F.col("scope") == "url", F.col("url"))
    return fetches.withColumn("key", key).where("key is not null").groupBy("key").agg(F.min_by("access", "seq").alias("access"))


def policy_entries(intents: DataFrame, entries: DataFrame) -> DataFrame:
    """Each intent's first refusal among entries that name its outlet or its origin: opt-outs, then legal holds, then suppressions
    that still last. intents: intent_id, outlet, origin, at. entries: kind, outlet, origin (either null), until (suppressions)."""
    rank = F.when(F.col("kind") == "opt_out", 0).when(F.col("kind") == "legal_hold", 1).otherwise(2)
    ranked = entries.withColumn("rank", rank)
    hits = [intents.join(ranked.where(F.col(k).isNotNull()).select(k, "rank", "until"), k) for k in ("outlet", "origin")]
    live = hits[0].select("intent_id", "at", "rank", "until").unionByName(hits[1].select("intent_id", "at", "rank", "until")).where((F.col("rank") < 2) | (F.col("at") < F.col("until")))
    best = live.groupBy("intent_id").agg(F.min("rank").alias("rank"))
    said = F.when(F.col("rank") == 0, "DENY:explicit_opt_out").when(F.col("rank") == 1, "DENY:legal_review_hold").when(F.col("rank") == 2, "DEFER:temporarily_suppressed").otherwise("ALLOW")
    return intents.select("intent_id").join(best, "intent_id", "left").select("intent_id", said.alias("decision"))
