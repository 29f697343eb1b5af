"""HTML in Arrow batches: segments, main text with the rule that kept or dropped each block, metadata with basis, visible text.

One tolerant parse gives a page's blocks in order, each with its tag, the containers around it and its share of link text.
The main container is the one with the most paragraph text of its own and of half its children's; the rules then drop what
is navigation, a wall or a repetition. The version is part of every result: a changed rule is a new version.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from html import escape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

VERSION = "main-text/1"
_BLOCK = frozenset("address article aside blockquote body dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody td tfoot th thead tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = frozenset("script style noscript template svg iframe object select option textarea button".split())
_FRAME = frozenset("nav footer aside form header menu".split())
_MARKS = re.compile(r"(?:^|[\s_-])(ad|ads|banner|breadcrumb|comment|comments|cookie|footer|menu|nav|newsletter|related|share|sidebar|social|sponsor|subscribe|widget)(?:[\s_-]|$)", re.I)
_SPACE = re.compile(r"\s+")
#: Bytes of a compressed body that are inflated at most.
INFLATED = 64 << 20


class _Blocks(HTMLParser):
    """Blocks, meta tags, JSON-LD, links and times of a page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.path: list[tuple[str, int, bool]] = []  # tag, container number, framed
        self.blocks: list[dict] = []
        self.containers: list[tuple[str, int]] = []  # tag, parent's number
        self.text: list[str] = []
        self.linked = 0
        self.links: list[tuple[str, str]] = []
        self.meta: list[tuple[str, str]] = []
        self.ld: list[str] = []
        self.silent = 0
        self.in_a = self.in_title = False
        self.title, self.lang, self.time, self.script = "", "", "", ""

    def _flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            tag = next((t for t, _, _ in reversed(self.path) if t in _BLOCK), "body")
            self.blocks.append({"tag": tag, "container": next((n for t, n, _ in reversed(self.path) if n >= 0), -1), "framed": any(f for _, _, f in self.path), "text": text, "link_share": min(1.0, self.linked / len(text)), "inside": [t for t, _, _ in self.path]})
        self.text, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a = {k: v or "" for k, v in attrs}
        if tag == "html":
            self.lang = a.get("lang", "")
        elif tag == "meta" and a.get("content"):
            self.meta.append(((a.get("property") or a.get("name") or a.get("itemprop") or "").lower(), a["content"]))
        elif tag == "time" and not self.time:
            self.time = a.get("datetime", "")
        elif tag == "link" and a.get("rel") == "canonical":
            self.meta.append(("canonical", a.get("href", "")))
        elif tag == "a":
            self.in_a = True
            self.links.append((a.get("href", ""), a.get("rel", "")))
        elif tag == "br":
            self.text.append(" ")
        if tag in _VOID:
            return
        if tag == "title":
            self.in_title = True
        if tag in _SILENT:
            self.silent += 1
            self.script = a.get("type", "") if tag == "script" else ""
        if tag in _BLOCK:
            self._flush()
            if tag in ("p", "li", "dt", "dd", "tr", "td", "th") and any(t == tag for t, _, _ in self.path[-2:]):
                self._close(tag)
        number = -1
        if tag in ("article", "main", "section", "div", "body", "td"):
            number = len(self.containers)
            self.containers.append((tag, next((n for _, n, _ in reversed(self.path) if n >= 0), -1)))
        framed = tag in _FRAME and not (tag == "header" and any(t == "article" for t, _, _ in self.path)) or bool(_MARKS.search(f"{a.get('class', '')} {a.get('id', '')}"))
        self.path.append((tag, number, framed))

    def _close(self, tag: str) -> None:
        while self.path:
            t, _, _ = self.path.pop()
            if t in _SILENT:
                self.silent = max(0, self.silent - 1)
            if t == tag:
                break

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.in_a = False
        if tag == "title":
            self.in_title = False
        if tag in _BLOCK:
            self._flush()
        if any(t == tag for t, _, _ in self.path):
            self._close(tag)

    def handle_data(self, data: str) -> None:
        if self.in_title:
            self.title += data
        elif self.silent:
            if self.script == "application/ld+json":
                self.ld.append(data)
        else:
            self.text.append(data)
            self.linked += len(data.strip()) if self.in_a else 0


def parsed(html: str | None) -> _Blocks:
    p = _Blocks()
    p.feed(html or "")
    p.close()
    p._flush()
    return p


def main_container(p: _Blocks) -> int:
    """Number of the container with the most paragraph text, its own and half of its children's; -1 for none."""
    score = [0.0] * len(p.containers)
    for b in p.blocks:
        if b["framed"] or b["link_share"] > 0.5 or b["tag"] not in ("p", "blockquote", "li", "div", "td", "pre", "article", "section", "main"):
            continue
        n, part = b["container"], float(len(b["text"]))
        while n >= 0 and part > 1:
            score[n] += part * (1.5 if p.containers[n][0] in ("article", "main") else 1.0)
            n, part = p.containers[n][1], part / 2
    return max(range(len(score)), key=lambda k: (score[k], -k), default=-1)


def _inside(p: _Blocks, number: int, container: int) -> bool:
    while number >= 0:
        if number == container:
            return True
        number = p.containers[number][1]
    return False


def extracted(html: str | None) -> dict:
    """Blocks with kind, role and rule; title and body text."""
    p = parsed(html)
    main, seen, out = main_container(p), set(), []
    for b in p.blocks:
        kind = "heading" if re.fullmatch("h[1-6]", b["tag"]) else {"li": "list_item", "blockquote": "quote", "figcaption": "caption"}.get(b["tag"], "paragraph")
        rule = "kept"
        if b["tag"] == "h1":
            kind, rule = "title", "title"
        elif b["framed"]:
            rule = "page_frame"
        elif main >= 0 and not _inside(p, b["container"], main):
            rule = "outside_main"
        elif b["link_share"] > 0.5:
            rule = "mostly_links"
        elif kind == "caption":
            rule = "caption"
        elif len(b["text"]) >= 20 and b["text"] in seen:
            rule = "repeated"
        seen.add(b["text"])
        out.append({"kind": kind, "role": "body" if rule == "kept" else "title" if rule == "title" else "other", "rule": rule, "text": b["text"]})
    return {"parsed": p, "blocks": out, "body": "\n\n".join(b["text"] for b in out if b["role"] == "body"), "title": next((b["text"] for b in out if b["kind"] == "title"), "")}


def ld_nodes(texts: list[str]) -> Iterator[dict]:
    """Every object of the page's JSON-LD, nested ones too."""
    stack = []
    for t in texts:
        try:
            stack.append(json.loads(t))
        except ValueError:
            continue
    while stack:
        x = stack.pop()
        if isinstance(x, dict):
            yield x
            stack += reversed([*x.values()])
        elif isinstance(x, list):
            stack += reversed(x)


def metadata(html: str | None) -> dict[str, tuple[str | None, str]]:
    """Value and basis of title, author, published, modified, section and language, each from the first source that has one."""
    e = extracted(html)
    p, nodes = e["parsed"], [*ld_nodes(e["parsed"].ld)]
    meta: dict[str, str] = {}
    for k, v in p.meta:
        meta.setdefault(k, v.strip())

    def ld(key: str) -> str:
        for n in nodes:
            v = n.get(key)
            v = v[0] if isinstance(v, list) and v else v
            v = v.get("name") if isinstance(v, dict) else v
            if isinstance(v, str) and v.strip():
                return v.strip()
        return ""

    sources = {
        "title": [("json_ld", ld("headline")), ("og", meta.get("og:title", "")), ("h1", e["title"]), ("title_tag", _SPACE.sub(" ", p.title).strip())],
        "author": [("json_ld", ld("author")), ("meta", meta.get("author", "")), ("article", meta.get("article:author", ""))],
        "published": [("json_ld", ld("datePublished")), ("article", meta.get("article:published_time", "")), ("meta", meta.get("date", "")), ("time", p.time)],
        "modified": [("json_ld", ld("dateModified")), ("article", meta.get("article:modified_time", ""))],
        "section": [("json_ld", ld("articleSection")), ("article", meta.get("article:section", ""))],
        "language": [("html", p.lang), ("og", meta.get("og:locale", ""))],
    }
    return {k: next(((v, b) for b, v in found if v), (None, "unknown")) for k, found in sources.items()}


class Undecodable(ValueError):
    """A compressed body that is refused; its reason says why."""


def inflated(body: bytes, encoding: str) -> bytes:
    """The whole of a gzip (all members) or deflate (zlib or raw) body; one that is broken, incomplete or over INFLATED bytes is refused."""
    for bits in (31,) if encoding == "gzip" else (15, -15):
        out, left = b"", body
        try:
            while True:
                stream = zlib.decompressobj(bits)
                out += stream.decompress(left, INFLATED + 1 - len(out))
                if len(out) > INFLATED:
                    raise Undecodable("decoded body exceeds the size limit")
                if not stream.eof:
                    raise Undecodable(f"{encoding}: incomplete stream")
                left = stream.unused_data
                if bits != 31 or not left.startswith(b"\x1f\x8b"):
                    return out
        except zlib.error as error:
            if bits != 15:
                raise Undecodable(f"{encoding}: {error}") from error
    raise AssertionError("raw deflate is tried last")


def decoded(body: bytes, encoding: str | None = None, charset: str | None = None) -> tuple[str, str, int]:
    """Text, charset with its basis, and how many characters were replaced: BOM, header, meta, then UTF-8."""
    if encoding in ("gzip", "deflate") and body:
        body = inflated(body, encoding)
    for mark, name in ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16")):
        if body.startswith(mark):
            return (t := body.decode(name, "replace")), "bom", t.count("�")
    stated = re.search(rb"<meta[^>]+charset=[\"']?([\w-]+)", body[:4096], re.I)
    for basis, name in (("header", charset), ("meta", stated[1].decode() if stated else None), ("default", "utf-8")):
        try:
            if name:
                return (t := body.decode(name, "replace")), basis, t.count("�")
        except LookupError:
            continue
    raise AssertionError("utf-8 is always there")


def sanitized(html: str | None) -> str:
    """An inert page: text and plain structure, without scripts, styles, links' targets or event handlers."""
    out = []
    for b in parsed(html).blocks:
        tag = b["tag"] if b["tag"] in ("p", "li", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "td") else "p"
        out.append(f"<{tag}>{escape(b['text'])}</{tag}>")
    return "\n".join(out)


def _mapped(pages: DataFrame, fn, schema: str) -> DataFrame:
    """Rows of fn(page_id, html) for each page; pages without an id or a text are pages too."""
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = [r for page_id, html in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)) for r in fn(page_id, html)]
                if rows:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html")).mapInArrow(run, schema)


def segments(pages: DataFrame) -> DataFrame:
    """One row for each block: i, tag, text, whether framed, link share and digest."""
    def fn(page_id: int, html: str | None) -> list[tuple]:
        return [(page_id, i, b["tag"], b["text"], b["framed"], b["link_share"], hashlib.sha256(b["text"].encode()).hexdigest()) for i, b in enumerate(parsed(html).blocks)]

    return _mapped(pages, fn, "page_id long, i int, tag string, text string, framed boolean, link_share double, sha256 string")


def extract(pages: DataFrame) -> DataFrame:
    """One row for each page: title, body, numbers of blocks kept and dropped, digest, version."""
    def fn(page_id: int, html: str | None) -> list[tuple]:
        e = extracted(html)
        kept = sum(b["role"] == "body" for b in e["blocks"])
        return [(page_id, VERSION, "EXTRACTED" if kept else "NOT_EXTRACTABLE", e["title"], e["body"], kept, len(e["blocks"]) - kept, hashlib.sha256(e["body"].encode()).hexdigest())]

    return _mapped(pages, fn, "page_id long, extractor string, outcome string, title string, body string, kept int, dropped int, body_sha256 string")


def block_decisions(pages: DataFrame) -> DataFrame:
    """One row for each block with its kind, role and the rule that decided."""
    return _mapped(pages, lambda page_id, html: [(page_id, i, b["kind"], b["role"], b["rule"], b["text"]) for i, b in enumerate(extracted(html)["blocks"])], "page_id long, i int, kind string, role string, rule string, text string")


def page_metadata(pages: DataFrame) -> DataFrame:
    """One row for each page and field: value and basis."""
    return _mapped(pages, lambda page_id, html: [(page_id, k, v, b) for k, (v, b) in metadata(html).items()], "page_id long, field string, value string, basis string")


def visible_text(pages: DataFrame) -> DataFrame:
    return _mapped(pages, lambda page_id, html: [(page_id, "\n".join(b["text"] for b in parsed(html).blocks))], "page_id long, text string")


def inert_pages(pages: DataFrame) -> DataFrame:
    return _mapped(pages, lambda page_id, html: [(page_id, sanitized(html))], "page_id long, html string")


#: Extractors by name and version; the version is part of every record and of its fingerprint.
EXTRACTORS = {VERSION: extract}
