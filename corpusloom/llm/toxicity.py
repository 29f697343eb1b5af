"""Toxicity by a weighted finite-state grammar.

Six deterministic transducers read the classes of a text's words: insult, threat, intent, target, negation and reported speech.
Their composition, one table, says of every insult or threat in which clause it stands: plain, aimed at a target, negated,
or reported. A text's score is a logistic function of the weights gathered for each kind of clause. Word weights and the
function's coefficients are fitted on a bounded sample of labelled rows (FIT_ROWS); learned insults join the fixed ones
when a few toxic texts, and hardly any others, hold them, however rare their language is.

Null and empty texts: the score of a text without matches. Repeated rows: equal scores. A null doc_id counts as the empty
id. Without usable labels the fixed weights hold. Labels, lang, source and doc_id are no inputs of a score.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import SLICE, fold_column, fold_of, id_text, row_map

FOLDS = 5
#: Labelled rows, chosen by hashes of their ids, on which weights are fitted at most.
FIT_ROWS = 20_000
#: A learned insult stands in this many toxic sample texts at least, and this many times as often as in others. All that do are learned: the sample bounds them.
LEARNED_TEXTS, LEARNED_ODDS = 4, 20.0

# Word classes of the grammar.
INSULTS = "idiot idiots moron morons stupid scum trash loser losers clown clowns pathetic worthless disgusting imbecile vermin filth dumb garbage crétin connard abruti salaud dummkopf trottel abschaum idioten estúpido imbécil basura escoria"
THREATS = "kill hurt destroy beat shoot stab hang burn crush tuer frapper brûler crever töten schlagen umbringen erschießen matar golpear quemar morir"
INTENT = "will gonna going shall must should deserve vais vas va doit werde wirst soll voy vas debe"
TARGETS = "you your yours yourself u he she they them him her these those people tu toi vous ton votre du dich dir euch ihr sie usted ustedes tú ti ellos"
NEGATIONS = "not no never n't isn't aren't wasn't don't doesn't didn't ne pas jamais nicht kein keine nie nunca jamás ni"
REPORTING = "said says say wrote writes quoted called claims claimed reported according told dit écrit selon sagte sagt schrieb laut dijo dice escribió según"

OTHER, INSULT, THREAT, INTEND, TARGET, NEGATE, REPORT, CLAUSE, SENTENCE = range(9)
KINDS = ("plain", "aimed", "negated", "reported", "threat", "bare_threat")
#: Coefficients where there is nothing to fit: bias, then one for each kind.
DEFAULT = np.array([-3.0, 3.0, 3.5, 0.3, 0.8, 4.0, 0.3])

_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_WORDS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")


@dataclass(frozen=True)
class Transducer:
    """Deterministic: start state 0, step(state, class) -> state, and read(state) -> a label of the context."""

    states: int
    step: Callable[[int, int], int]
    read: Callable[[int], int]


def within(opener: int, reach: int, closers: tuple[int, ...]) -> Transducer:
    """Label 1 for `reach` words after an opener, until a closer."""
    return Transducer(reach + 1, lambda s, c: reach if c == opener else 0 if c in closers else max(0, s - 1), lambda s: int(s > 0))


def since(opener: int, closer: int) -> Transducer:
    return Transducer(2, lambda s, c: 1 if c == opener else 0 if c == closer else s, lambda s: s)


def emitting(word: int) -> Transducer:
    """Label 1 right at a word of its class."""
    return Transducer(2, lambda s, c: int(c == word), lambda s: s)


def compose(machines: tuple[Transducer, ...]) -> tuple[list[list[int]], list[tuple[int, ...]]]:
    """The product as a table of next states by state and class, and the labels of each state."""
    spaces = [*product(*(range(m.states) for m in machines))]
    number = {s: k for k, s in enumerate(spaces)}
    table = [[number[tuple(m.step(x, c) for m, x in zip(machines, s))] for c in range(9)] for s in spaces]
    return table, [tuple(m.read(x) for m, x in zip(machines, s)) for s in spaces]


def grammar() -> tuple[list[list[int]], list[int]]:
    """Transitions, and per state the kind of clause that the word just read completes, or -1."""
    table, labels = compose((emitting(INSULT), emitting(THREAT), within(INTEND, 4, (CLAUSE, SENTENCE)), within(TARGET, 5, (CLAUSE, SENTENCE)), within(NEGATE, 4, (CLAUSE, SENTENCE)), since(REPORT, SENTENCE)))

    def kind(insult: int, threat: int, intent: int, target: int, negated: int, reported: int) -> int:
        if not insult and not threat:
            return -1
        if reported:
            return 3
        if negated:
            return 2
        if threat:
            return 4 if intent or target else 5
        return 1 if target else 0

    return table, [kind(*x) for x in labels]


def base_classes() -> dict[str, int]:
    out = {}
    for number, words in ((REPORT, REPORTING), (TARGET, TARGETS), (INTEND, INTENT), (NEGATE, NEGATIONS), (THREAT, THREATS), (INSULT, INSULTS)):
        out |= dict.fromkeys(words.split(), number)
    return out


class Grammar:
    """The composed machine with its words' classes and weights."""

    def __init__(self, weights: dict[str, float]) -> None:
        self.table, self.kind = grammar()
        self.classes = base_classes() | {w: INSULT for w in weights if base_classes().get(w, OTHER) == OTHER}
        self.weights = weights
        self.memo: dict[str, tuple[tuple[int, float], ...]] = {}
        self.quiet: set[str] = set()

    def read(self, raw: str) -> tuple[tuple[int, float], ...]:
        """Classes and weights of a white-space word: its words, then the boundary that its punctuation sets."""
        out = [(self.classes.get(w, OTHER), self.weights.get(w, 1.0)) for w in _WORDS.findall(raw)]
        tail = _EDGE.search(raw[1:] if len(raw) > 1 else raw)
        tail = tail[0] if tail and raw.endswith(tail[0]) else ""
        if any(c in ".!?…" for c in tail):
            out.append((SENTENCE, 0.0))
        elif any(c in ",;:|()" for c in tail):
            out.append((CLAUSE, 0.0))
        return tuple(out)

    def features(self, text: str) -> list[float]:
        gathered = [0.0] * len(KINDS)
        memo = self.memo
        if len(memo) > 300_000:
            memo.clear()
            self.quiet.clear()
        lines = []
        for line in text.lower().split("\n"):
            words = line.split()
            for w in words:
                if w not in memo:
                    memo[w] = self.read(w)
                    if not any(c in (INSULT, THREAT) for c, _ in memo[w]):
                        self.quiet.add(w)
            if words and not self.quiet.issuperset(words):
                lines.append(words)
        for words in lines:  # a line's end ends its sentence, so lines without a match change nothing
            state = 0
            for w in words:
                for c, weight in memo[w]:
                    state = self.table[state][c]
                    if (k := self.kind[state]) >= 0:
                        gathered[k] += weight
        return gathered


def shaped(features: np.ndarray) -> np.ndarray:
    """Bias and the damped sums."""
    return np.concatenate([np.ones((len(features), 1)), np.log1p(features)], axis=1)


def logistic_fit(features: np.ndarray, labels: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Newton's method, drawn towards DEFAULT, so that kinds that the sample lacks keep their coefficients."""
    x, w = shaped(features), DEFAULT.copy()
    pull = np.full(x.shape[1], ridge)
    pull[0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), x.T @ (labels - p) - pull * (w - DEFAULT))
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    coefficients: np.ndarray


def hash_sample(df: DataFrame, key: str, rows: int, slots: int = 4096) -> DataFrame:
    """At most `rows` rows, by the key's hash: its slots are counted, and taken whole from the first on, as far as they fit."""
    slot = F.pmod(F.xxhash64(key), F.lit(slots))
    taken, room = [], rows
    for r in sorted(df.groupBy(slot.alias("slot")).count().collect()):  # `slots` rows at most
        if r["count"] <= room:
            taken.append(r.slot)
            room -= r["count"]
    return df if len(taken) == slots else df.where(slot.isin(taken))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """From labelled rows outside the held-out fold, at most `rows` of them; what reaches the driver is bounded by that."""
    labels = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold_column(F.col("doc_id"), FOLDS) != 0))
    chosen = hash_sample(labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")), "doc_id", rows)
    texts = id_text(docs).join(F.broadcast(chosen), "doc_id")  # at most `rows` pairs of numbers

    schema = pa.schema([("toxic", pa.int32()), ("words", pa.list_(pa.string()))])
    words = texts.select("toxic", "text").mapInArrow(row_map(lambda toxic, text: [(toxic, sorted({*_WORDS.findall(text.lower())}))], schema), "toxic int, words array<string>")
    totals = words.groupBy("toxic").count().collect()
    n = {r.toxic: r["count"] for r in totals}
    bad, good = n.get(1, 0), n.get(0, 0)
    if not bad or not good:
        return Model({}, DEFAULT)
    counted = words.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(F.sum("toxic").alias("p"), F.sum(1 - F.col("toxic")).alias("q"))
    odds = F.log(((F.col("p") + 0.5) / (bad + 1)) / ((F.col("q") + 0.5) / (good + 1)))
    fixed = [*base_classes()]
    strong = counted.withColumn("odds", odds).where(((F.col("p") >= LEARNED_TEXTS) & (F.col("odds") > math.log(LEARNED_ODDS))) | F.col("word").isin(fixed))
    found = strong.orderBy(F.col("word").isin(fixed).desc(), F.col("odds").desc(), "word").collect()
    known = base_classes()
    weights = {r.word: min(4.0, max(0.1, r.odds / 2)) for r in found if known.get(r.word, INSULT) in (INSULT, THREAT)}

    schema = pa.schema([("toxic", pa.int32()), ("x", pa.list_(pa.float64()))])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Grammar(weights)
        yield from row_map(lambda toxic, text: [(toxic, tool.features(text))], schema)(batches)

    # equal feature rows are one row with a count
    sample = texts.select("toxic", "text").mapInArrow(measure, "toxic int, x array<double>").groupBy("x", "toxic").count().collect()
    counts: dict[tuple, float] = defaultdict(float)
    for r in sample:
        counts[tuple(r.x), r.toxic] += r["count"]
    keys = sorted(counts)
    repeat = np.array([counts[k] for k in keys], dtype=int)
    return Model(weights, logistic_fit(np.repeat(np.array([k[0] for k in keys]), repeat, axis=0), np.repeat(np.array([k[1] for k in keys], dtype=float), repeat)))


def scores(texts: list[str], tool: Grammar, model: Model) -> np.ndarray:
    x = shaped(np.array([tool.features(t) for t in texts]).reshape(len(texts), len(KINDS)))
    return 1 / (1 + np.exp(-np.clip(x @ model.coefficients, -30, 30)))


def score_toxicity(df: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Grammar(model.weights)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                ids, texts = (c.to_pylist() for c in batch.slice(at, SLICE).columns)
                s = scores(texts, tool, model)
                yield pa.record_batch({"doc_id": pa.array(ids, pa.int64()), "held_out": [fold_of(i, FOLDS) == 0 for i in ids], "score": s, "predicted": pa.array((s >= 0.5).astype(int), pa.int32())})

    return id_text(df).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def filter_toxicity(df: DataFrame, model: Model) -> DataFrame:
    """The rows of df, with all its columns, whose text scores below one half."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Grammar(model.weights)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                yield part.filter(pa.array(scores([t or "" for t in part.column(part.schema.get_field_index("text")).to_pylist()], tool, model) < 0.5))

    return df.mapInArrow(run, df.schema)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return score_toxicity(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
