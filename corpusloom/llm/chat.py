"""Chat formatting: a hidden Markov model recovers who speaks in each line of a transcript; turns are then rendered canonically.

A state is a role with whether the line begins a turn. A line is seen as its speaker marker, its length, and whether it asks.
Emissions and transitions are counted over the labelled conversations outside the held-out fold (all of them; the counts are
a table of fixed size). The lines are range-partitioned in their order and cut into blocks of BLOCK lines of one conversation.
Viterbi runs by block: tasks reduce each block to its best scores from every state before it to every state at its end, a
conversation's blocks are chained through these, and each block is then decoded between its two known ends. The result
is that of one run over the whole conversation, but no task holds a long one, be it of many turns, of one turn of many lines or
of many rows with one turn number.

The query's transcripts are written so that a marker alone does not settle a line: one turn in UNMARKED has none, and one in
MISMARKED that of another role.

Null text: one empty line. Null ids: a conversation of their own; a null turn comes first. Repeated turns: lines in the order
of their texts. An empty table gives none. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from corpusloom.llm.common import fold_column, written

ROLES = ("user", "assistant", "system")
#: Lines of a conversation that a task decodes at a time.
BLOCK = 1024
#: Turns that the query writes without a marker, and with a wrong one: one in so many, by hash.
UNMARKED, MISMARKED = 10, 50
FOLDS = 5
# Names that open a turn, for each role.
NAMES = {"user": "user|human|q|question|client|customer|me", "assistant": "assistant|ai|bot|a|answer|agent|gpt|model", "system": "system|instructions?|context|note"}
#: Marker styles in which the query writes its transcripts; {} stands for the name.
STYLES = (("{}: ", ("User", "Assistant", "System")), ("{}: ", ("Human", "AI", "Instruction")), ("{}: ", ("Q", "A", "Context")), ("### {}: ", ("user", "assistant", "system")))
MARKERS, LENGTHS, ASKS = len(ROLES) + 1, 4, 2
CODES = MARKERS * LENGTHS * ASKS
STATES = 2 * len(ROLES)  # role + 3 where the turn goes on
BEGIN = STATES
#: Lines of each kind assumed beside what is counted: markers mostly tell the truth, at a turn's beginning.
PRIOR_TRUE, PRIOR_OTHER = 20.0, 0.0005


def marker_pattern(names: str) -> str:
    return rf"(?i)^\s*(?:[#>*\[(-]+\s*)*(?:{names})\s*(?:\*\*|\])?\s*:\s*(?:\*\*)?\s?"


def line_code(line: Column) -> Column:
    """The line's observation as a number: marker, length, question."""
    marker = F.coalesce(*[F.when(line.rlike(marker_pattern(NAMES[r])), k + 1) for k, r in enumerate(ROLES)], F.lit(0))
    n = F.length(line)
    length = F.when(n == 0, 0).when(n < 40, 1).when(n < 160, 2).otherwise(3)
    return (marker * LENGTHS + length) * ASKS + F.when(line.rlike(r"\?\s*$"), 1).otherwise(0)


def without_marker(line: Column, role: Column) -> Column:
    out = line
    for r in ROLES:
        out = F.when(role == r, F.regexp_replace(line, marker_pattern(NAMES[r]), "")).otherwise(out)
    return out


def transcript_lines(conversations: DataFrame) -> DataFrame:
    """conv, turn, i, line and the true role of conversations written out with speaker markers, most of them right, in a style by conversation."""
    base = conversations.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"), F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    style = F.pmod(F.xxhash64("conv"), F.lit(len(STYLES)))
    marker = F.lit("")
    dice = F.xxhash64("conv", "turn")
    told = F.when(F.pmod(dice, F.lit(MISMARKED)) == 1, F.when(F.col("role") == "user", "assistant").otherwise("user")).when(F.pmod(dice, F.lit(UNMARKED)) != 0, F.col("role"))
    for k, (form, names) in enumerate(STYLES):
        for r, name in zip(ROLES, names):
            marker = F.when((style == k) & (told == r), form.format(name)).otherwise(marker)
    return base.select("conv", "turn", "role", F.posexplode(F.split(F.concat(marker, "text"), "\n")).alias("i", "line"))


def text_lines(texts: DataFrame) -> DataFrame:
    """The same columns, without roles, of whole transcripts. texts: conv, text."""
    return texts.select(F.col("conv").cast("string").alias("conv"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("turn", "line")).select("conv", F.col("turn").cast("long").alias("turn"), F.lit(0).alias("i"), "line")


def fit(lines: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Log transition (STATES + begin, STATES) and emission (STATES, CODES) tables from lines with known roles."""
    role = F.coalesce(*[F.when(F.col("role") == r, k) for k, r in enumerate(ROLES)])
    known = lines.where(fold_column(F.col("conv"), FOLDS) != 0).withColumn("r", role).where("r is not null").withColumn("state", F.col("r") + F.when(F.col("i") == 0, 0).otherwise(len(ROLES)))
    emitted = known.groupBy("state", line_code(F.col("line")).alias("code")).count().collect()  # STATES x CODES rows at most
    turns = known.groupBy("conv", "turn").agg(F.min("r").alias("r"), F.count("*").alias("n"))
    before = turns.select("conv", (F.col("turn") + 1).alias("turn"), F.col("r").alias("q"), F.col("n").alias("m"))
    moved = turns.join(before, ["conv", "turn"], "left").groupBy("r", "q", (F.col("m") > 1).alias("long")).agg(F.count("*").alias("k"), F.sum(F.col("n") - 1).alias("on"), F.count_if(F.col("n") > 1).alias("longer")).collect()

    roles = len(ROLES)
    counts = np.zeros((STATES, MARKERS, LENGTHS, ASKS))
    for row in emitted:
        counts[row.state].flat[row.code] += row["count"]
    marker, length, ask = counts.sum((2, 3)) + PRIOR_OTHER, counts.sum((1, 3)) + 1.0, counts.sum((1, 2)) + 1.0
    for state in range(STATES):
        marker[state, state + 1 if state < roles else 0] += PRIOR_TRUE
    share = lambda c: np.log(c / c.sum(1, keepdims=True))  # noqa: E731  the three features are taken as independent given the state
    emission = (share(marker)[:, :, None, None] + share(length)[:, None, :, None] + share(ask)[:, None, None, :]).reshape(STATES, CODES)
    transition = np.zeros((STATES + 1, STATES))
    transition[:, :roles] = 1.0
    transition[:roles, roles:] += np.eye(roles)
    transition[roles:STATES, roles:] += np.eye(roles)
    for row in moved:
        start = BEGIN if row.q is None else row.q + (roles if row.long else 0)
        transition[start, row.r] += row.k
        transition[row.r, row.r + roles] += row.longer
        transition[row.r + roles, row.r + roles] += row.on - row.longer
    with np.errstate(divide="ignore"):
        return np.log(transition / transition.sum(1, keepdims=True)), emission


def block_scores(codes: np.ndarray, transition: np.ndarray, emission: np.ndarray) -> np.ndarray:
    """Best score from each state before the block (or its beginning) to each state at its end."""
    best = transition + emission[:, codes[0]]
    for c in codes[1:]:
        best = (best[:, :, None] + transition[None, :STATES]).max(1) + emission[:, c]
    return best


def decode(codes: np.ndarray, entry: int, end: int, transition: np.ndarray, emission: np.ndarray) -> list[int]:
    """The best states between the state before the block and that of its last line (-1: any)."""
    score, back = transition[entry] + emission[:, codes[0]], []
    for c in codes[1:]:
        steps = score[:, None] + transition[:STATES]
        back.append(steps.argmax(0))
        score = steps.max(0) + emission[:, c]
    path = [int(score.argmax()) if end < 0 else end]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def chain(matrices: list[np.ndarray]) -> list[tuple[int, int]]:
    """(state before, state at the end) of each block of a conversation on its best path."""
    score, back = matrices[0][BEGIN], []
    for m in matrices[1:]:
        steps = score[:, None] + m[:STATES]
        back.append(steps.argmax(0))
        score = steps.max(0)
    ends = [int(score.argmax())]
    for b in reversed(back):
        ends.append(int(b[ends[-1]]))
    ends.reverse()
    return [*zip([BEGIN, *ends], ends)]


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Rows whose first columns are equal; they lie together, across batches too."""
    rows = (row for batch in batches for at in range(0, batch.num_rows, 1024) for row in zip(*(c.to_pylist() for c in batch.slice(at, 1024).columns)))
    for _, group in groupby(rows, key=lambda r: r[:keys]):
        yield [*group]


def _packed(rows: Iterator[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == 2048:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
            held = []
    if held:
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)


def recover_roles(lines: DataFrame, model: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """conv, turn, i, line with the role found and the ordinal of the recovered turn, and lines' other columns. lines: conv, turn, i, line."""
    transition, emission = model
    order = ("conv", "block", "turn", "i", "line")
    extra = [c for c in lines.columns if c not in order]
    coded = lines.select("conv", F.lit(0).cast("long").alias("block"), "turn", F.col("i").cast("int").alias("i"), "line", line_code(F.col("line")).alias("code"), *extra)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, left, last = (TaskContext.get().partitionId() << 32) - 1, 0, None  # blocks are numbered in the order of the lines
        for batch in batches:
            made = []
            for conv in batch.column(0).to_pylist():
                if conv != last or not left:
                    block, left, last = block + 1, BLOCK, conv
                left -= 1
                made.append(block)
            yield batch.set_column(1, "block", pa.array(made, pa.int64()))

    seen = written(coded.repartitionByRange("conv", "turn", "i").sortWithinPartitions("conv", "turn", "i", "line").mapInArrow(number, coded.schema), "lines")

    def reduce_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = ((g[0][0], g[0][1], block_scores(np.array([r[5] for r in g]), transition, emission).ravel().tolist()) for g in _groups(batches, 2))
        yield from _packed(made, ["conv", "block", "best"], [pa.string(), pa.int64(), pa.list_(pa.float64())])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = ((conv, block, a, b) for g in _groups(batches, 1) for (conv, block, _), (a, b) in zip(g, chain([np.array(r[2]).reshape(STATES + 1, STATES) for r in g])))
        yield from _packed(made, ["conv", "block", "entry", "end"], [pa.string(), pa.int64(), pa.int32(), pa.int32()])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for g in _groups(batches, 2):
                starts = 0
                for r, state in zip(g, decode(np.array([r[5] for r in g]), g[0][6], g[0][7], transition, emission)):
                    starts += state < len(ROLES)
                    yield (*r[:5], ROLES[state % len(ROLES)], starts, *r[8:])

        yield from _packed(rows(), names, types)

    columns = (*order, "code")
    best = seen.select(*columns).repartition("conv", "block").sortWithinPartitions(*order).mapInArrow(reduce_, "conv string, block long, best array<double>")
    ends = written(best.repartition("conv").sortWithinPartitions("conv", "block").mapInArrow(link, "conv string, block long, entry int, end int"), "ends")
    both = seen.join(ends, ["conv", "block"]).select(*columns, "entry", "end", *extra).repartition("conv", "block").sortWithinPartitions(*order)
    kinds = {f.name: f for f in to_arrow_schema(both.schema)}
    names, types = [*order, "role", "nth", *extra], [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), *(kinds[c].type for c in extra)]
    told = ", ".join(f"`{c}` {both.schema[c].dataType.simpleString()}" for c in extra)
    found = written(both.mapInArrow(solve, "conv string, block long, turn long, i int, line string, role string, nth long" + (", " + told if told else "")), "found")
    per = found.groupBy("conv", "block").agg(F.max("nth").alias("starts"))
    offset = written(per.select("conv", "block", (F.sum("starts").over(Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)) - F.col("starts")).alias("offset")), "offsets")
    return found.join(offset, ["conv", "block"]).select("conv", "turn", "i", "line", "role", (F.col("offset") + F.col("nth") - 1).alias("ordinal"), *extra)


def rendered(recovered: DataFrame) -> DataFrame:
    """conv, turn (recovered, from 0), role, n_lines, text and canonical rendering of each turn."""
    turns = recovered.groupBy("conv", "ordinal").agg(F.min("role").alias("role"), F.count("*").alias("n_lines"), F.array_sort(F.collect_list(F.struct("turn", "i", "line"))).alias("lines"))
    text = F.array_join(F.transform("lines", lambda x: x["line"]), "\n")
    turns = turns.select("conv", F.col("ordinal").alias("turn"), "role", "n_lines", without_marker(text, F.col("role")).alias("text"))
    return turns.withColumn("rendered", F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("<|end|>\n")))


def chat_report(conversations: DataFrame) -> DataFrame:
    """Every conversation written out, parsed again and rendered: one row for each recovered turn, with digests, whether its
    conversation is of the held-out fold, and how many of its lines have the role that the conversation gives them."""
    lines = transcript_lines(conversations)
    found = recover_roles(lines.withColumnRenamed("role", "true_role"), fit(lines))
    right = found.groupBy("conv", F.col("ordinal").alias("turn")).agg(F.count_if(F.col("role") == F.col("true_role")).alias("n_right"))
    out = rendered(found).join(right, ["conv", "turn"])
    return out.select(
        F.when(F.col("conv") != "", F.col("conv")).cast("long").alias("conv_id"), "turn", "role", "n_lines", "n_right", (fold_column(F.col("conv"), FOLDS) == 0).alias("held_out"), F.sha2("text", 256).alias("text_sha256"), F.sha2("rendered", 256).alias("rendered_sha256"),
    )
