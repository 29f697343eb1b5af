"""Channel documents: RSS, Atom, sitemaps, HTML listings and robots files, told apart by their bytes, to rows of entries."""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import urljoin, urlsplit
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame

from corpusloom.functions.html import parsed

ENTRY = "document_url string, format string, position int, relation string, raw_url string, url string, problem string, title string, stated string"
ROBOTS = "document_url string, agent string, rule string, allow boolean, position int"


def local(tag: str) -> str:
    return tag.rpartition("}")[2]


def resolve(raw: str | None, base: str) -> tuple[str | None, str | None]:
    """Absolute address, or what is wrong with it."""
    if not (raw or "").strip():
        return None, "no_url"
    try:
        url = urljoin(base, raw.strip())
        parts = urlsplit(url)
    except ValueError:
        return None, "unparseable"
    return (url, None) if parts.scheme in ("http", "https") and parts.hostname else (None, "not_a_web_address")


def _text(node, *names: str) -> str:
    return next(((c.text or "").strip() for n in names for c in node if local(c.tag) == n and (c.text or "").strip()), "")


def rss(root) -> Iterator[tuple[str, str, str, str]]:
    for item in (x for x in root.iter() if local(x.tag) == "item"):
        guid = next((g for g in item if local(g.tag) == "guid"), None)
        permalink = (guid.text or "") if guid is not None and guid.get("isPermaLink", "true") != "false" else ""
        yield "item", _text(item, "link") or permalink, _text(item, "title"), _text(item, "pubDate", "date")


def atom(root) -> Iterator[tuple[str, str, str, str]]:
    def link(node, rel: str) -> str:
        return next((x.get("href", "") for x in node if local(x.tag) == "link" and x.get("rel", "alternate") == rel), "")

    for entry in (x for x in root if local(x.tag) == "entry"):
        yield "item", link(entry, "alternate"), _text(entry, "title"), _text(entry, "published", "updated")
    if link(root, "next"):
        yield "next", link(root, "next"), "", ""


def sitemap(root) -> Iterator[tuple[str, str, str, str]]:
    space = root.tag.rpartition("}")[0]
    relation = "child" if local(root.tag) == "sitemapindex" else "item"
    for node in root:
        own = lambda name: next(((c.text or "").strip() for c in node if c.tag == (space + "}" if space else "") + name), "")  # noqa: B023, E731
        yield relation, own("loc"), "", own("lastmod")


def listing(text: str) -> Iterator[tuple[str, str, str, str]]:
    for href, rel in parsed(text).links:
        yield ("next" if "next" in rel.split() else "item"), href, "", ""


def entries(document_url: str, body: str | None) -> list[tuple]:
    """Rows of a channel document. A document type declaration outside comments and CDATA is refused."""
    body = (body or "").lstrip("﻿ \t\r\n")
    bare = re.sub(r"<!--.*?-->|<!\[CDATA\[.*?\]\]>", "", body, flags=re.S)
    if not body:
        return [(document_url, "empty", 0, "problem", None, None, "empty_document", None, None)]
    if re.match(r"(<\?xml|<rss|<feed|<urlset|<sitemapindex|<rdf)", body, re.I):
        if re.search(r"<!(DOCTYPE|ENTITY)", bare, re.I):
            return [(document_url, "xml", 0, "problem", None, None, "document_type_refused", None, None)]
        try:
            root = ElementTree.fromstring(body)
        except ElementTree.ParseError:
            return [(document_url, "xml", 0, "problem", None, None, "malformed_xml", None, None)]
        kind, read = {"rss": ("rss", rss), "rdf": ("rss", rss), "feed": ("atom", atom), "urlset": ("sitemap", sitemap), "sitemapindex": ("sitemap_index", sitemap)}.get(local(root.tag).lower(), ("xml", lambda _: ()))
        found = [*read(root)]
    else:
        kind, found = "html", [*listing(body)]
    return [(document_url, kind, i, relation, raw, *resolve(raw, document_url), title or None, stated or None) for i, (relation, raw, title, stated) in enumerate(found)]


def robots(document_url: str, body: str | None) -> list[tuple]:
    """Rules of each agent; consecutive agent lines share the rules that follow."""
    out, agents, ruled = [], [], False
    for i, line in enumerate((body or "").splitlines()):
        name, colon, value = line.partition("#")[0].partition(":")
        name, value = name.strip().lower(), value.strip()
        if not colon:
            continue
        if name == "user-agent":
            agents, ruled = ([value.lower()] if ruled else [*agents, value.lower()]), False
        elif name in ("allow", "disallow"):
            ruled = True
            out += [(document_url, a, value, name == "allow", i) for a in agents if value]
    return out


def _mapped(df: DataFrame, fn, schema: str) -> DataFrame:
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [r for url, body in zip(pdf["document_url"], pdf["body"]) for r in fn(url, body)]
            yield pd.DataFrame(rows, columns=names)

    return df.select("document_url", "body").mapInPandas(run, schema)


def channel_entries(df: DataFrame) -> DataFrame:
    """df: document_url, body (text)."""
    return _mapped(df, entries, ENTRY)


def robots_rules(df: DataFrame) -> DataFrame:
    return _mapped(df, robots, ROBOTS)
