"""Channel documents, packs, stores; streaming results equal batch results."""

import gzip

import pytest
from pyspark.sql import functions as F

from corpusloom import streaming
from corpusloom.operators import reuse
from corpusloom.sources import channels, tables

RSS = '<rss version="2.0"><channel><title>c</title><item><title>a</title><link>/a</link><pubDate>Mon, 01 Jan 2024 00:00:00 GMT</pubDate></item><item><guid>http://x.com/b</guid></item><item><guid isPermaLink="false">7</guid></item></channel></rss>'
ATOM = '<feed xmlns="http://www.w3.org/2005/Atom"><link rel="next" href="?p=2"/><entry><title>t</title><link rel="edit" href="/e"/><link href="/a"/><updated>2024-01-01</updated></entry></feed>'
SITEMAP = '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" xmlns:n="urn:n"><url><loc>http://x.com/a</loc><n:loc>no</n:loc><lastmod>2024</lastmod></url><url></url></urlset>'


@pytest.mark.parametrize(
    "body, want",
    [
        (RSS, [("rss", "item", "http://x.com/a", None), ("rss", "item", "http://x.com/b", None), ("rss", "item", None, "no_url")]),
        (ATOM, [("atom", "item", "http://x.com/a", None), ("atom", "next", "http://x.com/f?p=2", None)]),
        (SITEMAP, [("sitemap", "item", "http://x.com/a", None), ("sitemap", "item", None, "no_url")]),
        ("<html><a href='/q'>x</a><a href='javascript:1'>y</a><a rel='next' href='?p=2'>n</a>", [("html", "item", "http://x.com/q", None), ("html", "item", None, "not_a_web_address"), ("html", "next", "http://x.com/f?p=2", None)]),
        ("<?xml version='1.0'?><!DOCTYPE a [<!ENTITY b 'c'>]><rss/>", [("xml", "problem", None, "document_type_refused")]),
        ("<rss><channel>", [("xml", "problem", None, "malformed_xml")]),
        ("", [("empty", "problem", None, "empty_document")]),
    ],
)
def test_channels(body, want):
    assert [(r[1], r[3], r[5], r[6]) for r in channels.entries("http://x.com/f", body)] == want


def test_channel_frame(spark):
    df = spark.createDataFrame([("http://x.com/f", RSS), ("http://x.com/g", None)], "document_url string, body string")
    assert channels.channel_entries(df).count() == 4
    robots = spark.createDataFrame([("r", "User-agent: a\nUser-agent: b\nDisallow: /x\nAllow: /x/y\n\nUser-agent: *\nDisallow:\n")], "document_url string, body string")
    assert channels.robots_rules(robots).count() == 4


def test_packs(spark, tmp_path):
    record = lambda kind, body: gzip.compress(b"WARC/1.1\r\nWARC-Type: %s\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (kind, len(body), body))
    (tmp_path / "a.warc.gz").write_bytes(record(b"response", b"one\r\n\r\ntwo") + record(b"metadata", b""))
    (tmp_path / "b.warc.gz").write_bytes(record(b"response", b"x")[:-4])
    got = tables.pack_records(spark, str(tmp_path)).collect()
    assert sorted((r.kind or "", r.problem or "") for r in got) == [("", "torn"), ("metadata", ""), ("response", "")]
    assert next(bytes(r.payload) for r in got if r.kind == "response") == b"one\r\n\r\ntwo"
    assert tables.file_listing(spark, str(tmp_path)).count() == 2


def test_write_once(spark):
    store = spark.createDataFrame([("f1", "a", "p")], "fingerprint string, payload_sha256 string, payload string")
    new = spark.createDataFrame([("f1", "a", "p"), ("f2", "b", "q"), ("f2", "b", "q"), ("f3", "c", "r"), ("f3", "d", "s")], "fingerprint string, payload_sha256 string, payload string")
    fresh, clash = tables.put_once(store, new)
    assert [r.fingerprint for r in fresh.collect()] == ["f2"] and [r.fingerprint for r in clash.collect()] == ["f3"]
    assert tables.keyed_conflicts(new, "fingerprint").count() == 1


def test_lenient_lines(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text('{"a": 1}\n{"a": 2}\n{"a": ')
    from pyspark.sql.types import LongType, StructType

    schema = StructType().add("a", LongType())
    assert tables.read_lenient(spark, str(tmp_path), schema).count() == 2
    with pytest.raises(Exception):  # noqa: B017
        tables.read_strict(spark, str(tmp_path), schema).collect()


TRANSITIONS = [(None, "new"), ("new", "open"), ("open", "done"), ("done", "open")]
EVENTS = [(1, "k1", "new"), (2, "k1", "open"), (3, "k1", "new"), (4, "k2", "open"), (5, "k1", "done"), (6, "k2", "new"), (6, "k2", "new"), (7, "k1", "open")]


def _landed(spark, path, rows, schema, parts):
    for k in range(parts):
        spark.createDataFrame(rows[k * len(rows) // parts : (k + 1) * len(rows) // parts], schema).coalesce(1).write.mode("append").parquet(path)


def test_machine_stream_is_batch(spark, tmp_path):
    schema = "event_id long, subject string, state string"
    _landed(spark, str(tmp_path / "in"), EVENTS, schema, 3)
    batch = streaming.machine_batch(spark.createDataFrame(EVENTS, schema), "subject", "event_id", "state", TRANSITIONS)
    stream = streaming.machine(streaming.file_stream(spark, str(tmp_path / "in"), schema, 1), "subject", "event_id", "state", TRANSITIONS)
    streaming.drained(stream, str(tmp_path / "out"), str(tmp_path / "check"))
    key = lambda df: sorted(tuple(r) for r in df.select("key", "at", "new_state", "allowed").collect())
    assert key(spark.read.parquet(str(tmp_path / "out"))) == key(batch)


def test_once_per_id(spark, tmp_path):
    schema = "event_id long, subject string, state string"
    _landed(spark, str(tmp_path / "in"), EVENTS, schema, 4)
    streaming.drained(streaming.once_per_id(streaming.file_stream(spark, str(tmp_path / "in"), schema, 1), "event_id"), str(tmp_path / "out"), str(tmp_path / "check"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == len({e[0] for e in EVENTS})


def test_incremental_reuse_is_batch(spark, tmp_path):
    words = [f"w{i}" for i in range(90)]
    rows = [(i, "abc"[i % 3], " ".join(words[i : i + 70] if i % 2 else words[:80] + [f"x{i}"])) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, outlet string, text string")
    store = streaming.ReuseStore(str(tmp_path / "s"), str(tmp_path / "r"))
    for k in range(3):
        store.add(df.where(F.col("doc_id") % 3 == k), k)
    store.add(df.where(F.col("doc_id") % 3 == 2), 2)  # a batch that is repeated changes nothing
    key = lambda d: sorted(tuple(r) for r in d.select("document_id", "target_document_id").collect())
    assert key(store.read(spark)) == key(reuse.relations(df))
