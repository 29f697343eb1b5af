"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints are collapsed to distinct ones. Five blocks of bits give ten tables, one for each pair of blocks: three
differing bits leave at least two blocks equal, so every link meets in a table. Within a bucket the fingerprints' bit
planes are stored vertically, 64 lanes to a word; lane i is held against lane i + t for all i at once, the differing bits
run through a carry-save counter of two planes with a sticky overflow, and a block of lanes is left as soon as all of them
overflow. A task emits a spanning forest of the links in its bucket, never all pairs. Buckets above LANES fingerprints are
dealt out as pairs of blocks to different tasks.

Null or empty text: fingerprint zero, linked like any other. Repeated rows: the same component. Rows with a null doc_id
get a fingerprint and a null component; they link nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from corpusloom.llm.common import id_text, row_map, written
from corpusloom.operators.graph import components

RADIUS = 3
SEED = 42
SHINGLE = 3
#: Bits of the five blocks, from the lowest.
BLOCKS = (13, 13, 13, 13, 12)
#: Fingerprints of a bucket that one task compares; larger buckets are split.
LANES = 4096


def table_masks() -> list[int]:
    """One mask for each pair of blocks (radius + 2 blocks: any radius bits leave two of them whole)."""
    starts = [sum(BLOCKS[:k]) for k in range(len(BLOCKS))]
    blocks = [((1 << n) - 1) << s for n, s in zip(BLOCKS, starts)]
    return [a | b for a, b in combinations(blocks, 2)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: str) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, and x20, x09-x0D only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < SHINGLE:
        hashes = [xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = (ends - np.array([len(w) + 1 for w in words])).tolist()
        hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, (ends[SHINGLE - 1 :] - 1).tolist())]
    count = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 4096):
        part = np.array(hashes[at : at + 4096], dtype="<u8")
        count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame) -> DataFrame:
    """doc_id and fp (the 64 bits as a bigint) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
    return id_text(df).mapInArrow(row_map(lambda doc_id, text: [(doc_id, signed(fingerprint(text)))], schema), "doc_id long, fp long")


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """64 planes of the fingerprints' bits, 64 lanes to a word, with a spare word of zeros."""
    bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    words = len(fps) // 64 + 2
    packed = np.packbits(np.pad(bits, ((0, 0), (0, words * 64 - len(fps)))), axis=1, bitorder="little")
    return np.ascontiguousarray(packed).view(np.uint64)


def lanes(flags: np.ndarray, words: int) -> np.ndarray:
    return np.packbits(np.pad(flags, (0, words * 64 - len(flags))), bitorder="little").view(np.uint64)


def near_lanes(planes: np.ndarray, shift: int, valid: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Lanes i, of the valid ones, whose fingerprint differs from lane i + shift in at most radius (3) bits."""
    skip, bits = divmod(shift, 64)
    n = planes.shape[1] - 1 - skip
    ones, twos, over, ok = np.zeros(n, np.uint64), np.zeros(n, np.uint64), ~valid[:n], valid[:n]
    down, up = np.uint64(bits), np.uint64(64 - bits)
    for k, plane in enumerate(planes):
        other = plane[skip : skip + n] >> down
        if bits:
            other |= plane[skip + 1 : skip + n + 1] << up
        differ = plane[:n] ^ other
        carry = ones & differ
        ones ^= differ
        over |= twos & carry
        twos ^= carry
        if k % 4 == 3 and k > 8 and (over == ~np.uint64(0)).all():
            return np.zeros(0, np.int64)
    return np.flatnonzero(np.unpackbits((ok & ~over).view(np.uint8), bitorder="little"))


def forest(fps: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Root (a position) of each fingerprint under the links inside its group; groups lie together."""
    n = len(fps)
    root = np.arange(n)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return int(i)

    planes = bit_planes(fps)
    for shift in range(1, n):
        valid = groups[:-shift] == groups[shift:]
        if not valid.any():
            break
        at = near_lanes(planes, shift, lanes(valid, planes.shape[1]))
        at = at[root[at] != root[at + shift]]
        for i in at.tolist():
            a, b = find(i), find(i + shift)
            if a != b:
                root[max(a, b)] = min(a, b)
        if len(at):
            while not np.array_equal(root, up := root[root]):
                root = up
    return root


def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (group, doc, fp), groups together, to the links (doc, root's doc) of a spanning forest for each group."""
    rest = [np.zeros(0, np.int64) for _ in range(3)]

    def solve(group: np.ndarray, doc: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        cuts = np.flatnonzero(np.diff(group)) + 1
        starts = np.concatenate([[0], cuts, [len(group)]])
        sizes = np.diff(starts)
        small = np.repeat(sizes <= 64, sizes)
        jobs = [np.flatnonzero(small)] if small.any() else []
        jobs += [np.arange(starts[k], starts[k + 1]) for k in np.flatnonzero(sizes > 64)]
        for job in jobs:
            root = forest(np.ascontiguousarray(fp[job]).view(np.uint64), group[job])
            child = np.flatnonzero(root != np.arange(len(root)))
            if len(child):
                yield pa.record_batch({"a": doc[job[child]], "b": doc[job[root[child]]]})

    for batch in batches:
        columns = [np.concatenate([a, np.asarray(b)]) for a, b in zip(rest, batch.columns)]
        if not len(columns[0]):
            continue
        last = int(np.searchsorted(columns[0][::-1] != columns[0][-1], True))  # rows of the group that may go on
        end = len(columns[0]) - last
        rest = [c[end:] for c in columns]
        if end:
            yield from solve(*(c[:end] for c in columns))
    if len(rest[0]):
        yield from solve(*rest)


def links(nodes: DataFrame) -> DataFrame:
    """A forest of the links among distinct fingerprints. nodes: fp, doc (the smallest doc_id that has it)."""
    tables = F.array(*[F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for k, m in enumerate(table_masks())])
    rows = nodes.select("fp", "doc", F.explode(tables).alias("at")).select("fp", "doc", "at.t", "at.key")
    sizes = written(rows.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    parts = F.ceil(F.col("n") / F.lit(LANES)).cast("int")
    dealt = (
        rows.join(sizes, ["t", "key"])
        .withColumn("parts", parts)
        .withColumn("own", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("parts")))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(F.xxhash64("t", "key", F.least("own", "other"), F.greatest("own", "other")).alias("bucket"), "doc", "fp")
    )
    together = dealt.repartition("bucket").sortWithinPartitions("bucket", "fp")
    return together.mapInArrow(linked, "a long, b long")


def simhash_components(df: DataFrame) -> DataFrame:
    """doc_id, fingerprint and component_id of every row."""
    marks = written(fingerprints(df), "fingerprints")
    nodes = written(marks.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("doc")), "nodes")
    found = components(links(nodes))
    rooted = written(nodes.join(found, nodes.doc == found.u, "left").select("fp", F.coalesce("v", "doc").alias("component_id")), "rooted")
    out = marks.join(rooted, "fp", "left")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def one_of_each(df: DataFrame) -> DataFrame:
    """df with the smallest document of each component only, once; rows without a doc_id stay."""
    keep = simhash_components(df).where("doc_id = component_id").select("doc_id").distinct()
    return df.where("doc_id is not null").join(keep, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*df.columns).unionByName(df.where("doc_id is null"))
