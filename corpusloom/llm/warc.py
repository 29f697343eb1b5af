"""WARC archives: written by Spark's text writer, read back by boundary-chain verification.

Every record ends with an empty line (CRLF CRLF), and so do the record's own header and the HTTP header: with that line
separator the text writer lays down plain WARC/1.1 files, gzipped as a whole, of at most RECORDS_PER_ARCHIVE records. Reading
them back by the same separator gives the chunks of each archive in order. A task emits, for every chunk that looks like a
record header, inside payloads too, the candidate's offset and that of its successor. Pointer jumping from offset zero marks
the candidates that the chain reaches, in as many rounds as the binary logarithm of the chain's length; magic inside a
payload is never reached.

Null html: empty payload. Null url: an empty target. A page without an id gets a record of its own and a null page_id
when read. Repeated rows with one page_id: the equal payloads of the smallest id are all responses. An empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import cut, scratch_path, written

#: Archives stay below this; a longer output of a task goes on in another file.
RECORDS_PER_ARCHIVE = 4096
#: Payloads from this size on are revisits of an earlier equal one.
REVISIT_BYTES = 100
END = "\r\n\r\n"
MAGIC = "WARC/1.1\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8"
SCHEMA = "archive string, start long, successor long, page_id long, kind string, refers_to long, stated_digest string, stated_bytes long, payload_bytes long, payload_digest string"


def records(pages: DataFrame) -> DataFrame:
    """The record of every page as text, without its closing empty line."""
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")).withColumns({"digest": F.sha2(F.col("html").cast("binary"), 256), "n": F.octet_length("html")})
    marks = base.where((F.col("n") >= REVISIT_BYTES) & F.col("page_id").isNotNull()).select("page_id", "digest")
    first = written(marks.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("copies")).where("copies > 1"), "first")
    later = marks.join(first, "digest").where("page_id > refers_to").select("page_id", "refers_to").distinct()
    all_ = base.join(later.hint("shuffle_hash"), "page_id", "left")
    body = F.when(F.col("refers_to").isNull(), F.concat(F.lit(HTTP + END), "html")).otherwise(F.lit(HTTP + END))
    header = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(F.col("refers_to").isNull(), "response").otherwise("revisit"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")),
        F.lit(">\r\nWARC-Date: 2000-01-01T00:00:00Z\r\nWARC-Target-URI: "), F.regexp_replace("url", r"[\x00-\x20]", "+"),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nWARC-Payload-Digest: sha256:"), F.col("digest"),
        F.lit("\r\nWARC-Payload-Length: "), F.col("n").cast("string"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">")), F.lit("")),
        F.lit("\r\nContent-Length: "), F.octet_length("body").cast("string"),
    )
    return all_.withColumn("body", body).select(F.concat(header, F.lit(END), "body").alias("value"))


def write_archives(pages: DataFrame, path: str) -> None:
    records(pages).write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_ARCHIVE).text(path)


def _header(chunk: bytes) -> dict[str, str] | None:
    """Fields of a chunk that begins like a record's header, with lower-case names; None if it can't be one."""
    if not chunk.startswith(MAGIC.encode()):
        return None
    fields = {}
    for line in chunk.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields if fields.get("content-length", "").isdigit() else None


class _Open:
    """A candidate record whose block still arrives."""

    def __init__(self, archive: str, start: int, body: int, fields: dict[str, str]) -> None:
        self.archive, self.start, self.fields = archive, start, fields
        self.end = body + int(fields["content-length"])
        self.payload_from: int | None = None
        self.size, self.hash = 0, hashlib.sha256()

    def feed(self, at: int, data: bytes) -> None:
        """data lies at offset `at` of the archive; the payload begins after the first empty line of the block."""
        if self.payload_from is None:
            if at >= self.end:
                return
            self.payload_from = at + len(data)  # the HTTP header is the block's first chunk, its empty line included
            return
        part = data[: max(0, self.end - at)]
        self.size += len(part)
        self.hash.update(part)

    def row(self) -> tuple:
        number = lambda text: int(text[10:-1]) if text.startswith("<urn:page:") and text[10:-1].lstrip("-").isdigit() else None
        f = self.fields
        stated = f.get("warc-payload-length", "")
        return (self.archive, self.start, self.end + len(END), number(f.get("warc-record-id", "")), f.get("warc-type", ""), number(f.get("warc-refers-to", "")), f.get("warc-payload-digest", "").removeprefix("sha256:"), int(stated) if stated.isdigit() else None, self.size, self.hash.hexdigest())


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every possible record of the archives in path, with its successor's offset and what its payload holds."""
    chunks = spark.read.option("lineSep", END).text(path).select(F.col("_metadata.file_path").alias("archive"), F.col("value").cast("binary").alias("chunk"))
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = [{"string": pa.string(), "long": pa.int64()}[x.split()[1]] for x in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, at, open_ = None, 0, []
        for batch in batches:
            rows = []
            for name, chunk in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name != archive:  # gzip files aren't split: a file's chunks come in order, in one task
                    rows += [x.row() for x in open_]
                    archive, at, open_ = name, 0, []
                data = chunk + END.encode()
                for x in open_:
                    x.feed(at, data)
                early = 2 if chunk.startswith(b"\r\n") else 0  # left over where a payload's own line end met the separator
                fields = _header(chunk[early:])
                if fields is not None:
                    open_.append(_Open(archive, at + early, at + len(data), fields))
                at += len(data)
                rows += [x.row() for x in open_ if x.end <= at]
                open_ = [x for x in open_ if x.end > at]
            if rows:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
        if open_:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*[x.row() for x in open_]), kinds)], names=names)

    return chunks.mapInArrow(run, SCHEMA)


def reachable(found: DataFrame) -> DataFrame:
    """The candidates on the chain from offset zero of their archive, by pointer jumping."""
    jumps = cut(found.select("archive", "start", F.col("successor").alias("to"), (F.col("start") == 0).alias("on")))
    while True:
        # one round: a marked candidate marks its jump's end, and every jump is doubled
        ends = jumps.select("archive", F.col("start").alias("to"), F.col("to").alias("beyond"))
        marked = jumps.where("on").select("archive", F.col("to").alias("start")).distinct().withColumn("hit", F.lit(True))
        after = jumps.join(ends, ["archive", "to"], "left").join(marked, ["archive", "start"], "left")
        before, jumps = jumps, cut(after.select("archive", "start", F.coalesce("beyond", "to").alias("to"), (F.col("on") | F.coalesce("hit", F.lit(False))).alias("on")))
        if before.where("on").count() == jumps.where("on").count():
            return found.join(jumps.where("on").select("archive", "start"), ["archive", "start"], "left_semi")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record; a revisit has those of the payload it refers to."""
    chain = written(reachable(written(candidates(spark, path), "candidates")), "records")
    own = chain.where("kind = 'response'").select("page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    again = chain.where("kind = 'revisit'").select("page_id", "refers_to")
    source = own.where("page_id is not null").select(F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest").dropDuplicates(["refers_to"])
    return own.unionByName(again.join(source, "refers_to", "left").select("page_id", "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"), "refers_to"))


def warc_round_trip(pages: DataFrame) -> DataFrame:
    spark = pages.sparkSession
    path = scratch_path(spark, "archives")
    write_archives(pages, path)
    return read_archives(spark, path)
