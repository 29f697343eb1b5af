"""Best-fit packing of token sequences by minimum bin slack.

Tasks encode the texts, cut the long ones and number their pieces within each length. Only the histogram of lengths, at
most `capacity` rows, reaches the driver: per bin, the longest piece left is set and a subset-sum dynamic programme over
the lengths left, a bitset in one integer, finds the fullest feasible filling, which is removed as often as the counts
allow. The plan has at most a few runs per length; it is sent to the tasks, which turn a piece's rank among its length
into a sequence and an offset.

Null or empty text: one piece with the end id alone. Repeated rows: pieces of their own. A null doc_id is returned as it is.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusloom.llm.common import id_text, written

CAPACITY = 1024
END_ID = 2
#: Words that a worker remembers at most; beyond it the memory starts anew.
MEMO_WORDS = 300_000
#: Splits of the byte-level file (fixed value of the tokenizer): tokens never cross the seam between a visible character and the space or line end after it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts in which two white spaces meet, one stands at an end, or one is neither space nor line end are encoded whole.
IRREGULAR = re.compile(r"\s\s|\A\s|\s\Z|[^\S \n]|[\x1c-\x1f]")


class ByteCoder:
    """Little-endian ids of byte-level BPE; words are remembered, so that a frequent one is encoded once."""

    def __init__(self, path: str) -> None:
        self.library = Tokenizer.from_file(path)
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        from corpusloom.llm.bpe_trie import byte_symbols

        back = {c: b for b, c in byte_symbols().items()}
        ranks = {bytes(back[c] for c in token): i for token, i in vocabulary.items()}
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.plain = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.spaced: dict[str, bytes] = {}  # keys stand for " " + key
        self.first: dict[str, bytes] = {}

    @staticmethod
    def packed(ids: list[int]) -> bytes:
        return b"".join([i.to_bytes(4, "little") for i in ids])

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self.packed(self.library.encode(text, add_special_tokens=False).ids)
        if IRREGULAR.search(text):
            return self.packed(self.plain(text))
        if len(self.spaced) > MEMO_WORDS:
            self.spaced.clear()
        out, known, lead = [], self.spaced, ""
        for line in text.split("\n"):
            head, *words = line.split(" ")
            out.append(self.packed(self.plain(lead + head)))
            try:
                out += [known[w] for w in words]
            except KeyError:
                for w in words:
                    if w not in known:
                        known[w] = self.packed(self.plain(" " + w))
                out += [known[w] for w in words]
            lead = "\n"
        return b"".join(out)


@lru_cache(maxsize=2)
def byte_coder(path: str) -> ByteCoder:
    return ByteCoder(path)


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: full ones, after a first one that holds the rest."""
    head = n % capacity
    return ([(0, head)] if head else []) + [(at, capacity) for at in range(head, n, capacity)]


def fullest(counts: dict[int, int], lengths: list[int], room: int) -> list[int]:
    """The multiset of lengths, at most `counts` of each, with the largest sum of at most room. lengths: falling."""
    reach, taken, mask, goal = 1, [], (1 << (room + 1)) - 1, 1 << room
    for length in lengths:
        left, lot = min(counts[length], room // length), 1
        while left > 0:
            lot = min(lot, left)
            taken.append((length, lot, reach))
            reach |= (reach << (length * lot)) & mask
            if reach & goal:
                break
            left -= lot
            lot *= 2
        if reach & goal:
            break
    best, out = reach.bit_length() - 1, []
    for length, lot, before in reversed(taken):
        if not (before >> best) & 1:
            out += [length] * lot
            best -= length * lot
    return out


def minimum_slack_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """Runs (times, lengths of one bin) that use up the histogram."""
    counts = {k: v for k, v in histogram.items() if v > 0}
    lengths, plan = sorted(counts, reverse=True), []
    while lengths:
        seed = lengths[0]
        counts[seed] -= 1
        room = capacity - seed
        bin_ = [seed, *fullest(counts, lengths[bisect_right([-x for x in lengths], -room - 1) :], room)] if room else [seed]
        counts[seed] += 1
        times = min(counts[x] // bin_.count(x) for x in {*bin_})
        plan.append((times, sorted(bin_, reverse=True)))
        for x in {*bin_}:
            counts[x] -= times * bin_.count(x)
        lengths = [x for x in lengths if counts[x]]
    return plan


def plan_index(plan: list[tuple[int, list[int]]]) -> dict[int, tuple[list[int], list[tuple[int, list[int]]]]]:
    """Per length: first ranks of its runs, and for each run its first bin and its offsets in a bin."""
    out: dict[int, tuple[list[int], list[tuple[int, list[int]]]]] = {}
    used: dict[int, int] = {}
    first = 0
    for times, bin_ in plan:
        offsets: dict[int, list[int]] = {}
        at = 0
        for x in bin_:
            offsets.setdefault(x, []).append(at)
            at += x
        for x, places in offsets.items():
            starts, runs = out.setdefault(x, ([], []))
            starts.append(used.get(x, 0))
            runs.append((first, places))
            used[x] = used.get(x, 0) + times * len(places)
        first += times
    return out


def pieces(df: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every text, with the task that made them (part) and their number among its pieces of their length (nth)."""
    names = ("doc_id", "piece", "start", "length", "ids_crc32", "part", "nth")
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, part, seen, end = byte_coder(path), TaskContext.get().partitionId(), [0] * (capacity + 1), END_ID.to_bytes(4, "little")
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                rows = []
                for doc_id, text in zip(*(c.to_pylist() for c in batch.slice(at, 64).columns)):
                    ids = memoryview(tool.encode(text) + end)
                    for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                        rows.append((doc_id, k, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), part, seen[length]))
                        seen[length] += 1
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return id_text(df).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, part long, nth long")


def pack(df: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every text."""
    spark = df.sparkSession
    made = written(pieces(df, path, capacity), "pieces")  # numbers and parts are fixed from here on
    by_part = made.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = by_part.select("part", "length", (F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    histogram = {r.length: r.n for r in made.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    index = spark.sparkContext.broadcast(plan_index(minimum_slack_plan(histogram, capacity)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = index.value
        for batch in batches:
            sequence, offset = [], []
            for length, rank in zip(batch.column("length").to_pylist(), batch.column("rank").to_pylist()):
                starts, runs = plan[length]
                k = bisect_right(starts, rank) - 1
                first, places = runs[k]
                times, slot = divmod(rank - starts[k], len(places))
                sequence.append(first + times)
                offset.append(places[slot])
            yield pa.record_batch([*batch.columns[:5], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = made.join(before, ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"))
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
