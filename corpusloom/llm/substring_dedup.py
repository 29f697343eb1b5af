"""Removal of passages of 50 words or more that an earlier document holds, by suffix automata of reference shards.

Which texts must meet is found first. Every window of 50 words elects the least hash among its 16-word grams as its anchor;
equal windows elect equal anchors, so only windows under one anchor can be equal. A document's neighbouring windows with
one anchor are a piece (84 words at most). Anchors of a single document drop out, and equal pieces collapse to the first
document that has them: later ones are covered outright. What is left, different pieces under one anchor, are the reference
shards: a generalised suffix automaton over an anchor's pieces, fed in the order of their documents, gives the matching
statistics of each further piece; where these reach the threshold a window is covered. Anchors with more than SHARD pieces,
where an automaton would outgrow its bound, are dealt out by single windows instead, which equality of hashes decides.

A shard goes to the one task that holds its pieces and not to all: reference material grows with the corpus, so it has no
size that a broadcast could rely on. Words, grams and pieces are told apart by 64-bit hashes (a piece by two).

Null text: no words. Texts below 50 words stay whole. Rows with a null doc_id stay whole and are no reference. Rows that
repeat a doc_id are the same document. Equal texts: the smallest doc_id keeps its words.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from corpusloom.llm.common import SLICE, id_text, written

WINDOW = 50
GRAM = 16
#: Different pieces under one anchor that one automaton takes in: 256 x 84 words at most.
SHARD = 256
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class _Powers:
    """base^i and base^-i modulo 2^64, as far as a text has needed them."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 2 * len(cls.up), 4096)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                powers = np.full(size, base, np.uint64)
                powers[0] = 1
                setattr(cls, name, np.cumprod(powers, dtype=np.uint64))
        return cls.up[:n], cls.down[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.array([xxh64_intdigest(w, 7) for w in words], dtype=np.uint64)


class Rolling:
    """Hashes of any stretch of a text's words in constant time each."""

    def __init__(self, hashes: np.ndarray) -> None:
        up, self.down = _Powers.of(len(hashes) + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[:-1], dtype=np.uint64)])

    def stretch(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]


def text_pieces(hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Anchor, piece hash, first window and number of windows of each piece of a text."""
    n = len(hashes) - window + 1
    if n < 1:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    rolling = Rolling(hashes)
    at = np.arange(len(hashes) - gram + 1)
    grams = mixed(rolling.stretch(at, at + gram))
    span = window - gram + 1
    elected = np.concatenate([sliding_window_view(grams, span)[k : k + 8192].argmin(axis=1) + np.arange(k, min(k + 8192, n)) for k in range(0, n, 8192)])
    first = np.concatenate([[0], np.flatnonzero(np.diff(elected)) + 1])
    count = np.diff(np.concatenate([first, [n]]))
    anchor = elected[first]
    shape = (count * 64 + (anchor - first)).astype(np.uint64)
    return grams[anchor], mixed(rolling.stretch(first, first + count - 1 + window) + shape * np.uint64(_BASE)), first, count


def pieces(df: DataFrame) -> DataFrame:
    """anchor, piece, doc_id, first, n of every piece of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                found = []
                for doc_id, text in zip(*(c.to_pylist() for c in batch.slice(at, SLICE).columns)):
                    words = text.encode("utf-8", "surrogatepass").split()
                    if len(words) >= WINDOW:
                        anchor, piece, first, n = text_pieces(word_hashes(words))
                        found.append((anchor.view(np.int64), piece.view(np.int64), np.full(len(first), doc_id), first.astype(np.int32), n.astype(np.int32)))
                if found:
                    yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*found)], names=["anchor", "piece", "doc_id", "first", "n"])

    return id_text(df).where("doc_id is not null").mapInArrow(run, "anchor long, piece long, doc_id long, first int, n int")


class SuffixAutomaton:
    """Of several sequences; match() gives at each place the length of the longest suffix that one of them holds."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, symbol: int, q: int) -> int:
        """The part of state q that p reaches by one symbol, as a state of its own."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = clone
            p = self.link[p]
        return clone

    def add(self, sequence: list[int]) -> None:
        last = 0
        for symbol in sequence:
            if symbol in self.next[last]:
                last = self._split(last, symbol, self.next[last][symbol])
                continue
            new, p = self._state(self.length[last] + 1, 0, {}), last
            while p >= 0 and symbol not in self.next[p]:
                self.next[p][symbol] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, symbol, self.next[p][symbol])
            last = new

    def match(self, sequence: list[int]) -> list[int]:
        out, state, size = [], 0, 0
        for symbol in sequence:
            while state and symbol not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if symbol in self.next[state]:
                state, size = self.next[state][symbol], size + 1
            out.append(size)
        return out


def runs(flags: list[bool]) -> list[tuple[int, int]]:
    """(first, number) of the stretches of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], np.asarray(flags, dtype=np.int8), [0]])))
    return [(int(a), int(b - a)) for a, b in zip(edges[::2], edges[1::2])]


def shard_matches(rows: list[tuple[int, int, int, list[int]]], window: int = WINDOW) -> Iterator[tuple[int, int, int, int]]:
    """(anchor, piece, first, n) of the windows that a smaller doc_id of the shard holds. rows: (anchor, piece, doc_id, words)."""
    automaton, waiting, now = SuffixAutomaton(), [], None
    for anchor, piece, doc_id, words in sorted(rows, key=lambda r: r[2]):
        if doc_id != now:
            for sequence in waiting:
                automaton.add(sequence)
            waiting, now = [], doc_id
        for first, n in runs([size >= window for size in automaton.match(words)[window - 1 :]]):
            yield anchor, piece, first, n
        waiting.append(words)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with those of an anchor together, to covered windows."""

    def out(rows: list) -> Iterator[pa.RecordBatch]:
        found = [*shard_matches(rows)]
        if found:
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found)], names=["anchor", "piece", "from", "windows"])

    group: list = []
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            for row in zip(*(c.to_pylist() for c in batch.slice(at, SLICE).columns)):
                if group and group[0][0] != row[0]:
                    yield from out(group)
                    group = []
                group.append(row)
    if group:
        yield from out(group)


def needed_bits(ids: DataFrame, log_bits: int = 23) -> np.ndarray:
    """A bitmap of fixed size (1 MB) over hashes of doc_id: what it lacks is not needed."""
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1 << log_bits))
    words = ids.select(F.floor(h / 64).cast("int").alias("w"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(doc_id), {1 << log_bits}) % 64 as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    out = np.zeros(1 << (log_bits - 6), np.int64)
    for w, b in words.collect():  # 2^17 rows at most
        out[w] = b
    return out


def with_needed(docs: DataFrame, bits: np.ndarray, log_bits: int = 23) -> DataFrame:
    """The rows of docs whose doc_id may be needed."""
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.asarray(batch.column(batch.num_columns - 1))
            yield batch.filter(pa.array((sent.value[h >> 6] >> (h & 63)) & 1 == 1)).select(range(batch.num_columns - 1))

    return docs.withColumn("h", F.pmod(F.xxhash64("doc_id"), F.lit(1 << log_bits))).mapInArrow(keep, docs.schema)


def covered_windows(df: DataFrame) -> DataFrame:
    """doc_id, first, windows: windows of the document that also start in one with a smaller doc_id."""
    rows = written(pieces(df), "pieces")
    shared = written(rows.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("anchor"), "anchors")
    rows = written(rows.join(shared, "anchor"), "shared")
    firsts = written(rows.groupBy("anchor", "piece").agg(F.min(F.struct("doc_id", "first", "n")).alias("at")).select("anchor", "piece", F.col("at.doc_id").alias("owner"), F.col("at.first").alias("at"), F.col("at.n").alias("size")), "firsts")
    outright = rows.join(firsts.select("anchor", "piece", "owner"), ["anchor", "piece"]).where("doc_id > owner").select("doc_id", F.col("first").cast("long").alias("first"), F.col("n").cast("long").alias("windows"))

    variants = firsts.groupBy("anchor").agg(F.count("*").alias("variants")).where("variants > 1")
    wanted = written(firsts.join(variants, "anchor").groupBy(F.col("owner").alias("doc_id")).agg(F.collect_list(F.struct("anchor", "piece", "at", "size", (F.col("variants") > SHARD).alias("hot"))).alias("wanted")), "wanted")  # a document's own pieces
    texts = with_needed(id_text(df).where("doc_id is not null"), needed_bits(wanted.select("doc_id"))).dropDuplicates(["doc_id"]).join(wanted, "doc_id")

    def fetch(hot: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 64):
                    out = []
                    for doc_id, text, wanted in zip(*(c.to_pylist() for c in batch.slice(at, 64).columns)):
                        mine = [w for w in wanted if w["hot"] == hot]
                        if not mine:
                            continue
                        hashes = word_hashes(text.encode("utf-8", "surrogatepass").split())
                        if hot:
                            rolling = Rolling(hashes)
                            for w in mine:
                                start = np.arange(w["at"], w["at"] + w["size"])
                                x = rolling.stretch(start, start + WINDOW)
                                out += [(w["anchor"], w["piece"], doc_id, k, a, b) for k, (a, b) in enumerate(zip(mixed(x).view(np.int64).tolist(), mixed(x * np.uint64(5) + np.uint64(1)).view(np.int64).tolist()))]
                        else:
                            signed = hashes.view(np.int64)
                            out += [(w["anchor"], w["piece"], doc_id, signed[w["at"] : w["at"] + w["size"] - 1 + WINDOW]) for w in mine]
                    if out:
                        columns = [*zip(*out)]
                        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["anchor", "piece", "owner", "from", "x", "y"]) if hot else pa.record_batch([*[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.list_(pa.int64()))], names=["anchor", "piece", "owner", "words"])

        return run

    matched = texts.mapInArrow(fetch(False), "anchor long, piece long, owner long, words array<long>").repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_shards, "anchor long, piece long, `from` long, windows long")
    single = written(texts.mapInArrow(fetch(True), "anchor long, piece long, owner long, `from` long, x long, y long"), "windows")
    earliest = written(single.groupBy("x", "y").agg(F.min("owner").alias("least")), "earliest")
    dealt = single.join(earliest, ["x", "y"]).where("owner > least").select("anchor", "piece", "from", F.lit(1).cast("long").alias("windows"))
    inside = written(matched.unionByName(dealt), "inside").join(firsts, ["anchor", "piece"])
    own = rows.join(inside, ["anchor", "piece"]).where("doc_id = owner").select("doc_id", (F.col("first") + F.col("from")).alias("first"), "windows")
    return outright.unionByName(own)


def by_document(df: DataFrame) -> DataFrame:
    """doc_id and its covered windows as an array of (first, windows)."""
    return covered_windows(df).groupBy("doc_id").agg(F.collect_list(F.struct("first", "windows")).alias("covered"))


def removed_words(n: int, covered: list[dict] | None) -> np.ndarray:
    """Flags of the words that covered windows hold."""
    steps = np.zeros(n + 1, np.int64)
    for c in covered or ():
        steps[c["first"]] += 1
        steps[c["first"] + c["windows"] - 1 + WINDOW] -= 1
    return np.cumsum(steps)[:n] > 0


def dedup_report(df: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = []
                for doc_id, text, covered in zip(*(c.to_pylist() for c in batch.slice(at, SLICE).columns)):
                    words = text.encode("utf-8", "surrogatepass").split()
                    gone = removed_words(len(words), covered) if covered else None
                    kept = [w for w, g in zip(words, gone.tolist()) if not g] if covered else words
                    rows.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return id_text(df).join(by_document(df).hint("shuffle_hash"), "doc_id", "left").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_spans(text: str, covered: list[dict]) -> str:
    """The text without the words of covered windows and the white space before them; the rest stays as it is."""
    raw = text.encode("utf-8", "surrogatepass")
    words = [*_WORD.finditer(raw)]
    out, at = [], 0
    for first, n in runs(removed_words(len(words), covered).tolist()):
        out.append(raw[at : words[first - 1].end() if first else 0])
        at = words[first + n - 1].end()
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")


def remove_repeats(df: DataFrame) -> DataFrame:
    """df, with all its columns, its texts without repeated passages (and n_chars, if there, counted anew)."""
    spans = by_document(df)
    name = next(f"covered{k}" for k in range(len(df.columns) + 1) if f"covered{k}" not in df.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                texts = [without_spans(t, c) if c and t else t for t, c in zip(part.column("text").to_pylist(), part.column(name).to_pylist())]
                columns = {f: part.column(f) for f in part.schema.names if f != name}
                columns["text"] = pa.array(texts, part.schema.field("text").type)
                if "n_chars" in columns and pa.types.is_integer(columns["n_chars"].type):
                    columns["n_chars"] = pa.array([n if c is None else len(t or "") for t, c, n in zip(texts, part.column(name).to_pylist(), columns["n_chars"].to_pylist())], columns["n_chars"].type)
                yield pa.record_batch(columns)

    joined = df.join(spans.withColumnRenamed("covered", name).hint("shuffle_hash"), "doc_id", "left").select(*df.columns, name)
    return joined.mapInArrow(run, df.schema)
