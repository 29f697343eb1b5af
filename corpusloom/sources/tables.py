"""Row tables: strict and lenient JSON lines, chained lines, write-once stores, file listings, packs of gzip members."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_strict(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines of exactly this schema; a malformed line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_lenient(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines without those that don't parse (a torn last line)."""
    full = StructType.fromJson(schema.jsonValue()).add("_torn", "string")
    parsed = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_torn"})
    return spark.read.text(path).select(parsed.alias("r")).where("r._torn is null and r is not null").select(*[F.col("r")[f.name].alias(f.name) for f in schema])


def chained(rows: DataFrame, order: str, line: str = "line") -> DataFrame:
    """Adds previous_sha256, the digest of the line before. Within a partition key it is a window; here the table is one chain."""
    return rows.withColumn("previous_sha256", F.sha2(F.lag(F.concat(line, F.lit("\n"))).over(Window.orderBy(order)), 256))


def put_once(store: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows to append and conflicts: another payload under a fingerprint that is stored, or two new ones under one.

    Both tables: fingerprint, payload_sha256, payload.
    """
    per = new.groupBy("fingerprint").agg(F.min("payload_sha256").alias("lo"), F.max("payload_sha256").alias("hi"), F.min_by("payload", "payload_sha256").alias("payload"))
    seen = per.join(store.select("fingerprint", F.col("payload_sha256").alias("stored")), "fingerprint", "left")
    clash = (F.col("lo") != F.col("hi")) | (F.col("stored") != F.col("lo"))
    fresh = seen.where(F.col("stored").isNull() & ~F.coalesce(clash, F.lit(False))).select("fingerprint", F.col("lo").alias("payload_sha256"), "payload")
    return fresh, seen.where(F.coalesce(clash, F.lit(False))).select("fingerprint")


def keyed_conflicts(rows: DataFrame, key: str) -> DataFrame:
    """Keys under which two different rows stand; equal repeats fold."""
    mark = F.sha2(F.to_json(F.struct(*[c for c in rows.columns if c != key])), 256)
    return rows.groupBy(key).agg(F.count_distinct(mark).alias("versions")).where("versions > 1")


def file_listing(spark: SparkSession, path: str) -> DataFrame:
    """path, sha256 and size of every file below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))


MEMBER = "pack string, start long, length long, kind string, target string, payload binary, payload_sha256 string, problem string"


def members(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of each gzip member."""
    at = 0
    while at < len(data):
        z = zlib.decompressobj(31)
        content = z.decompress(data[at:]) + z.flush()
        if not z.eof:
            raise ValueError("torn member")
        used = len(data) - at - len(z.unused_data)
        yield at, used, content
        at += used


def pack_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of packs in which each WARC record is a gzip member of its own. A pack is read whole: packs are of bounded size."""
    names = [x.split()[0] for x in MEMBER.split(", ")]

    def one(name: str, data: bytes) -> Iterator[tuple]:
        try:
            for at, n, content in members(data):
                head, _, body = content.partition(b"\r\n\r\n")
                field = lambda k: (m[1].decode() if (m := re.search(rb"(?mi)^" + k + rb":\s*(.*?)\r?$", head)) else None)  # noqa: B023, E731
                size = field(b"Content-Length")
                payload = body[: int(size)] if size and size.isdigit() else body
                problem = None if size and body[int(size) :] == b"\r\n\r\n" else "length_differs"
                yield name, at, n, field(b"WARC-Type"), field(b"WARC-Target-URI"), payload, hashlib.sha256(payload).hexdigest(), problem
        except (ValueError, zlib.error):
            yield name, -1, 0, None, None, None, None, "torn"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, data in zip(pdf["path"], pdf["content"]):
                yield pd.DataFrame([*one(name, bytes(data))], columns=names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, MEMBER)
