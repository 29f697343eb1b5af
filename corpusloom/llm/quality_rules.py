"""Quality rules as a short-circuit cascade.

Each rule is a predicate on a lazily measured text. On a bounded sample every rule is timed and its rejections are
counted; the cascade then runs the rules by falling (rejections / cost), and a text leaves at its first rejection. The
order changes the cost only: a text is kept if no rule rejects it, in any order.

Null text: no words. Fewer than 50 words, the empty text included: base_failed. Repeated rows are judged alike. A null
doc_id is returned as it is. Other columns of the input are not read.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import SLICE, id_text

#: Rows, of texts of at most SAMPLE_BYTES, on which cost and selectivity are estimated; they decide the order of the rules, never a verdict.
SAMPLE_ROWS, SAMPLE_BYTES = 512, 1 << 15
MIN_WORDS = 50
SYMBOLS = b"#*$%&|<>"


class Measured:
    """Counts of one text, each made when it is first asked for."""

    def __init__(self, text: str) -> None:
        self.text = text

    @cached_property
    def raw(self) -> bytes:
        return self.text.encode("utf-8", "surrogatepass")

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()  # bytes.split() divides at x20 and x09-x0D only

    @property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(b"".join(self.words).decode("utf-8", "surrogatepass"))

    @cached_property
    def n_symbols(self) -> int:
        return sum(self.raw.count(SYMBOLS[i : i + 1]) for i in range(len(SYMBOLS)))

    @cached_property
    def lines(self) -> list[str]:
        return [x for x in self.text.split("\n") if x.encode("utf-8", "surrogatepass").split()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def word_ids(self) -> np.ndarray:
        seen: dict[bytes, int] = {}
        return np.array([seen.setdefault(w, len(seen)) for w in self.words], dtype=np.int64)

    @cached_property
    def n_distinct(self) -> int:
        return int(self.word_ids.max()) + 1 if self.n_words else 0

    @cached_property
    def n_repeat_words(self) -> int:
        ids = self.word_ids
        if len(ids) < 4:
            return 0
        pairs = ids[:-1] * self.n_distinct + ids[1:]
        if self.n_distinct > 1_000_000:  # keep the product of three ids below 2^63
            pairs = np.unique(pairs, return_inverse=True)[1]
        threes = pairs[:-1] * self.n_distinct + ids[2:]
        _, at, n = np.unique(threes, return_inverse=True, return_counts=True)
        again = n[at] > 1
        covered = np.zeros(len(ids), dtype=bool)
        for shift in range(3):
            covered[shift : shift + len(again)] |= again
        return int(covered.sum())

    @cached_property
    def _ascii(self) -> np.ndarray:
        return np.bincount(np.frombuffer(self.raw, dtype=np.uint8), minlength=256)

    @property
    def n_capitals(self) -> int:
        return int(self._ascii[65:91].sum())

    @property
    def n_ascii_letters(self) -> int:
        return int(self._ascii[65:91].sum() + self._ascii[97:123].sum())

    @property
    def n_digits(self) -> int:
        return int(self._ascii[48:58].sum())

    @property
    def n_shouts(self) -> int:
        return int(self._ascii[33])


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Measured], bool]


#: The first two are the base; the others are this method's own.
BASE = (
    Rule("too_short", lambda m: m.n_words < MIN_WORDS),
    Rule("repetitive", lambda m: 100 * m.n_repeat_words > 50 * m.n_words),
)
OWN = (
    Rule("symbols", lambda m: 100 * m.n_symbols > 25 * m.n_words),
    Rule("shouting", lambda m: 100 * m.n_shouts > 50 * m.n_words),
    Rule("capitals", lambda m: 100 * m.n_capitals > 60 * m.n_ascii_letters),
    Rule("repeated_lines", lambda m: 100 * m.n_dup_lines > 60 * len(m.lines)),
    Rule("digits", lambda m: 100 * m.n_digits > 40 * m.word_chars),
    Rule("word_length", lambda m: m.word_chars < 2 * m.n_words or m.word_chars > 20 * m.n_words),
    Rule("few_distinct_words", lambda m: 100 * m.n_distinct < 4 * m.n_words),
)
RULES = BASE + OWN
COLUMNS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_())])


def measured_order(df: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[int]:
    """Positions of the rules by falling rejections per nanosecond on at most sample_rows rows.

    take() reads one partition, and further ones only if it holds too few rows; nothing is shuffled. The driver times the
    rules on what it gets, 16 MB at most.
    """
    spent, out = [0] * len(rules), [0] * len(rules)
    for (text,) in id_text(df).select("text").where(F.octet_length("text") <= SAMPLE_BYTES).take(sample_rows):
        for k, rule in enumerate(rules):
            m = Measured(text)  # a new one each time: the cost of a rule includes what it must count
            t = time.perf_counter_ns()
            out[k] += bool(rule.rejects(m))
            spent[k] += time.perf_counter_ns() - t
    return sorted(range(len(rules)), key=lambda k: (-out[k] / max(1, spent[k]), k))


def passes(m: Measured, rules: tuple[Rule, ...], order: list[int]) -> bool:
    return not any(rules[k].rejects(m) for k in order)


def filter_quality(df: DataFrame, rules: tuple[Rule, ...] = RULES, order: list[int] | None = None) -> DataFrame:
    """The rows of df, with all its columns, whose text no rule rejects."""
    order = measured_order(df, rules) if order is None else order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                yield part.filter(pa.array([passes(Measured(t or ""), rules, order) for t in part.column(part.schema.get_field_index("text")).to_pylist()], pa.bool_()))

    return df.mapInArrow(run, df.schema)


def quality_report(df: DataFrame, rules: tuple[Rule, ...] = OWN, order: list[int] | None = None) -> DataFrame:
    """The base counts of every text and the cascade's verdict; a text that fails the base never enters the cascade."""
    order = measured_order(df, rules) if order is None else order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                rows = []
                for doc_id, text in zip(*(c.to_pylist() for c in part.columns)):
                    m = Measured(text)
                    failed = any(r.rejects(m) for r in BASE)
                    rows.append((doc_id, m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, failed, not failed and passes(m, rules, order)))
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), COLUMNS)], schema=COLUMNS)

    return id_text(df).mapInArrow(run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean")
