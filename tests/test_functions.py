"""Column functions and page functions on written cases."""

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import access, html, quality, states, text, urls


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("x")).first()["x"]


RULES = urls.KeyRules(("https://example.com", "http://example.com"), ("id", ""), ("/amp",), (".html",))


@pytest.mark.parametrize(
    "url, key",
    [
        ("https://EXAMPLE.com:443/a/../b/./c?utm_source=x&id=7#top", "https://example.com/b/c?id=7"),
        ("http://example.com/amp/story.html", "https://example.com/story"),
        ("https://example.com/%7euser/café%zz", "https://example.com/~user/caf%C3%A9%25zz"),
        ("https://example.com", "https://example.com/"),
        ("https://example.com/p?978027&x=1", "https://example.com/p?978027"),
        ("https://example.com//a//", "https://example.com//a//"),
        ("https://other.com/a", None),
        ("https://user@example.com/a", None),
        ("ftp://example.com/a", None),
        ("https://example.com:8080/a", None),
        ("https://example.com:x/a", None),
        ("https://example.com./a/b/..", "https://example.com/a/"),
        ("https://example.com/amp/amp/x.html.html/", "https://example.com/x/"),
        ("https://example.com/amp/", "https://example.com/"),
        ("https://example.com/amp", "https://example.com/amp"),
        ("https://example.com/.html", "https://example.com/"),
        ("https://example.com/a?id=2&id=1&b=&=x&z", "https://example.com/a?id=1&id=2&z"),
        ("https://example.com/a b", None),
        ("http://[bad", None),
        (None, None),
    ],
)
def test_url_key(spark, url, key):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(urls.key(F.col("u"), RULES).alias("k")).first().k == key
    if key:
        assert one(spark, urls.key(F.col("u"), RULES), u=key) == key  # the key of a key is the key


@pytest.mark.parametrize("url, out", [("http://a/b?utm_x=1&c=2#f", "http://a/b?c=2#f"), ("http://a/b?utm_x=1", "http://a/b"), ("http://a/b?c=2", "http://a/b?c=2"), ("http://a/b#utm_", "http://a/b#utm_")])
def test_without_tracking(spark, url, out):
    assert one(spark, urls.without_tracking(F.col("u")), u=url) == out


def test_flags(spark):
    f = lambda u: one(spark, urls.flags(F.col("u")), u=u)
    assert f("https://a.com/") == "front_or_top_level_page_url"
    assert f("https://a.com/tag/x/nota-larga-1") == "section_or_listing_url"
    assert f("https://a.com/autor/juan/") == "author_page_url"
    assert f("https://a.com/politica/una-nota-2024") == ""


def test_canonical_text(spark):
    assert one(spark, text.canonical(F.col("t")), t="  a​   b\n c﻿ ") == "a b c"
    assert one(spark, text.nfc(F.col("t")), t="é") == "é"


def test_grams_below_n(spark):
    assert one(spark, text.grams(text.words(F.col("t")), 3), t="a b") == []
    assert one(spark, text.grams(text.words(F.col("t")), 3), t="A b c d") == ["a b c", "b c d"]


def test_states(spark):
    rows = spark.createDataFrame([("a", 1, "known"), ("a", 2, "known"), ("b", 1, "known"), ("b", None, "unknown"), ("c", None, "unknown"), ("c", None, "unknown")], "k string, v long, v_state string")
    got = {r.k: (r.v, r.v_state) for r in rows.groupBy("k").agg(*states.known_sum("v")).collect()}
    assert got == {"a": (3, "known"), "b": (None, "not_available"), "c": (None, "unknown")}
    assert tuple(rows.limit(0).agg(*states.known_sum("v")).first()) == (0, "known")
    assert spark.createDataFrame([(None, "known"), (1, "unknown"), (1, "known"), (None, None)], "v long, v_state string").where(states.broken("v")).count() == 3


def test_access(spark):
    c = lambda status, body: one(spark, access.response_class(F.col("s"), F.col("b")), s=status, b=body)
    assert c(200, "x g-recaptcha") == "captcha"
    assert c(403, "x") == "forbidden"
    assert c(503, "Just a moment...") == "bot_challenge"
    assert c(200, "x" * 40000 + "g-recaptcha") == "none_observed"
    assert one(spark, access.allowance(F.col("n")), n=16) == 3
    assert one(spark, access.allowance(F.col("n")), n=1000) == 30


PAGE = """<html lang="es"><head><title>T &amp; t</title><meta property="og:title" content="OG"><link rel="canonical" href="/c">
<script>var t="</p>";</script><script type="application/ld+json">{"@graph":[{"headline":"LD","author":{"name":"Ana"}}]}</script></head><body>
<nav><a href="/x">menu menu menu menu menu</a></nav><article><header><h1>El título</h1></header><p>Primer párrafo con bastante texto para contar.
<p>Segundo párrafo, también largo, con un <a href="/y">enlace</a> dentro.</p><!-- c --><p>Segundo párrafo, también largo, con un enlace dentro.</p>
<div class="related"><p>Relacionado: otra nota que no es de aquí.</p></div></article><footer>Pie de página</footer></body></html>"""


def test_extraction():
    e = html.extracted(PAGE)
    assert e["title"] == "El título"
    assert e["body"] == "Primer párrafo con bastante texto para contar.\n\nSegundo párrafo, también largo, con un enlace dentro."
    assert {b["rule"] for b in e["blocks"]} == {"kept", "title", "page_frame", "repeated"}
    m = html.metadata(PAGE)
    assert m["title"] == ("LD", "json_ld") and m["author"] == ("Ana", "json_ld") and m["language"] == ("es", "html") and m["published"] == (None, "unknown")


@pytest.mark.parametrize("page", ["", None, "<p>", "plain text", "<div><p>a<div>b", "<select><option>a</select>x", "<!-- open"])
def test_odd_pages(page):
    html.extracted(page)
    html.metadata(page)
    assert "<script" not in html.sanitized(page)


def test_decoding():
    assert html.decoded("﻿é".encode()) == ("é", "bom", 0)
    assert html.decoded("é".encode("latin-1"), None, "latin-1") == ("é", "header", 0)
    assert html.decoded(b"\xff\x00a")[2] >= 1


def test_gate_reasons(spark):
    docs = spark.createDataFrame([(1, "s", ""), (2, "s", "hola " * 60), (3, "s", "hola " * 60), (4, "s", "x y z")], "doc_id long, source string, text string")
    rules = quality.RuleSet("t", min_words=50, min_function_share=0.0)
    got = {r.doc_id: r.reasons for r in quality.decide(quality.features(docs, "doc_id", "source"), rules, outlet="source", page="doc_id", order="doc_id").collect()}
    assert got == {1: "no_body", 2: "repetitive", 3: "repetitive,duplicate_of_earlier", 4: "too_short"}


def test_international_hosts(spark):
    rules = urls.KeyRules(("https://xn--caf-dma.es",))
    assert one(spark, urls.key(F.col("u"), rules), u="https://CAF\u00c9.es/x") == "https://xn--caf-dma.es/x"


def test_as_https(spark):
    known = F.array(F.lit("https://a.com"), F.lit("https://b.com"), F.lit("http://b.com"))
    f = lambda u: one(spark, urls.as_https(F.col("u"), known), u=u)
    assert f("http://A.com/x") == "https://A.com/x"
    assert all(f(u) is None for u in ("http://b.com/x", "https://a.com/x", "http://c.com/", "http://a.com:80/", "http://u@a.com/"))


def test_repeated_share_counts_all_occurrences(spark):
    """A block of 100 characters given twice is all of the text; blocks below 20 characters do not count."""
    docs = spark.createDataFrame([(1, "a" * 100 + "\n" + "a" * 100), (2, "a" * 100 + "\n" + "b" * 100 + "\n" + "A" * 100), (3, "ab\nab"), (4, ""), (5, "e\u0301" * 30 + "\n" + "\u00e9" * 30)], "doc_id long, text string")
    assert {r.doc_id: r.repeated_share for r in quality.features(docs, "doc_id").collect()} == {1: 1.0, 2: 0.667, 3: 0.0, 4: 0.0, 5: 1.0}


def test_versions_of_the_gate(spark):
    body = "de la que el en y a los se del " * 20 + "\n" + "Resumen generado con inteligencia artificial"
    docs = spark.createDataFrame([(1, body)], "doc_id long, text string")
    known = quality.Page(url=F.lit("https://a/zona-comercial/x"), status=F.lit(200), extracted=F.lit(True), title=F.lit("Minuto a minuto"), stated_characters=F.lit(5000), stated_text_characters=F.lit(900), live_blog=F.lit(False))
    f = lambda rules: [n for n, c in quality.page_reasons(rules, known) if quality.features(docs).select(c.alias("c")).first().c]
    shared = ["sponsored", "live_coverage"]
    assert f(quality.RULES_2) == ["machine_text", *shared, "incomplete_against_stated_body", "repetitive"]
    assert f(quality.RULES_3) == [*shared, "incomplete_against_stated_body", "repetitive"]
    assert f(quality.RULES_4) == [*shared, "repetitive"]


def test_compressed_bodies_are_whole_or_refused(monkeypatch):
    import gzip
    import zlib

    monkeypatch.setattr(html, "INFLATED", 1000)
    whole = b"a" * 1000
    raw = zlib.compressobj(wbits=-15)
    for body, encoding in ((gzip.compress(whole), "gzip"), (gzip.compress(whole[:400]) + gzip.compress(whole[:600]), "gzip"), (zlib.compress(whole), "deflate"), (raw.compress(whole) + raw.flush(), "deflate")):
        assert html.decoded(body, encoding)[0] == whole.decode()
    for pack, encoding in ((gzip.compress, "gzip"), (zlib.compress, "deflate")):
        for body, reason in ((pack(whole + b"a"), "size limit"), (pack(whole)[:-6], "incomplete"), (b"\xff\xffplain", encoding)):
            with pytest.raises(html.Undecodable, match=reason):
                html.decoded(body, encoding)


def test_redirects_outcomes_and_labels(spark):
    from corpusloom.operators import sequences

    f = lambda p: one(spark, access.redirect_class(F.col("p")), p=p)
    assert f("/Login/x") == "login_redirect" and f("/a/b") is None
    rows = [("DENIED", 200, None, False, "DENIED_BY_POLICY"), ("DEFERRED", None, None, False, "DEFERRED_BY_POLICY"), (None, 200, None, False, "TRANSIENT_FAILURE"), ("FETCHED", 301, "u", False, "MOVED_PERMANENTLY"), ("FETCHED", 204, None, False, "SUCCESS"), ("FETCHED", 304, None, True, "NOT_MODIFIED"), ("FETCHED", 304, None, False, "TRANSIENT_FAILURE"), ("FETCHED", 404, None, False, "NOT_FOUND"), ("FETCHED", 410, None, False, "GONE"), ("FETCHED", 429, None, False, "TRANSIENT_FAILURE"), ("FETCHED", 302, None, False, "REDIRECT_NOT_FOLLOWED"), ("FETCHED", 403, None, False, "REFUSED_BY_SERVER")]
    df = spark.createDataFrame(rows, "final string, status int, moved string, again boolean, want string")
    assert df.where(~sequences.outcome(F.col("final"), F.col("status"), F.col("moved"), F.col("again")).eqNullSafe(F.col("want"))).count() == 0
    w = lambda *x: one(spark, access.weakest(*[F.lit(v) for v in x]), k=1)
    assert w("measured", "assumed") == "assumed" and w("measured", "estimated") == "estimated" and w("measured", "measured") == "measured"


def test_hints_and_waits_beyond_the_tables(spark):
    from corpusloom.operators import intake

    f = lambda t: spark.createDataFrame([(t,)], "t string").select(F.unix_seconds(intake.hint_instant(F.col("t"))).alias("x")).first().x
    assert f("2026-01-02") == 1767312000 and f("2026-01-02T01:00:00.5+01:00") == 1767312000 and f("2026-01-02 00:00") == 1767312000
    assert f("Fri, 02 Jan 2026 00:00:00 GMT") == 1767312000 and f("2 Jan 2026 01:00 +0100") == 1767312000 and f("Thu, 01 Jan 2026 19:00:00 EST") == 1767312000
    assert all(f(t) is None for t in (None, "", "soon", "2026-13-40", "2026"))
