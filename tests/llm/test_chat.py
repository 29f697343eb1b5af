"""Chat formatting: block-wise Viterbi is one run, turns come back from written transcripts."""

import itertools
import random
import re
import zlib

import numpy as np
import pytest

from corpusloom.llm import chat


def model(seed=1):
    rng = np.random.default_rng(seed)
    allowed = np.ones((chat.STATES + 1, chat.STATES), bool)
    allowed[:, 3:] = False
    allowed[[0, 1, 2, 3, 4, 5], [3, 4, 5, 3, 4, 5]] = True
    with np.errstate(divide="ignore"):
        return np.log(rng.random(allowed.shape) * allowed), np.log(rng.random((chat.STATES, chat.CODES)))


def test_decode_is_brute_force():
    t, e = model()
    rng = random.Random(2)
    for _ in range(30):
        codes = np.array([rng.randrange(chat.CODES) for _ in range(4)])
        score = lambda p: t[chat.BEGIN, p[0]] + e[p[0], codes[0]] + sum(t[a, b] + e[b, c] for a, b, c in zip(p, p[1:], codes[1:]))  # noqa: B023, E731
        best = max(itertools.product(range(chat.STATES), repeat=4), key=score)
        assert abs(score(chat.decode(codes, chat.BEGIN, -1, t, e)) - score(best)) < 1e-9


def test_blocks_are_one_run():
    t, e = model(3)
    rng = random.Random(4)
    for _ in range(30):
        codes = [rng.randrange(chat.CODES) for _ in range(rng.randint(1, 40))]
        blocks = [np.array(codes[k : k + 7]) for k in range(0, len(codes), 7)]
        ends = chat.chain([chat.block_scores(b, t, e) for b in blocks])
        path = [s for b, (a, z) in zip(blocks, ends) for s in chat.decode(b, a, z, t, e)]
        assert path == chat.decode(np.array(codes), chat.BEGIN, -1, t, e)


SCHEMA = "conv_id long, turn long, role string, text string, line string, code string"


def conversations():
    rng = random.Random(5)
    out = []
    for c in range(40):
        for k in range(rng.randint(1, 9) if c else 300):
            role = ["user", "assistant"][k % 2] if k or c % 3 else "system"
            out.append((c, k, role, "\n".join(" ".join(f"w{rng.randint(0, 99)}" for _ in range(rng.randint(1, 30))) + ("?" if role == "user" else ".") for _ in range(rng.randint(1, 4))), "x", "y"))
    return out


@pytest.mark.parametrize("block", [64, 3])
def test_turns_come_back(spark, block, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", block)
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(chat, "UNMARKED", 1 << 60)
    monkeypatch.setattr(chat, "MISMARKED", 1 << 60)
    lines = chat.transcript_lines(df)
    got = sorted((r.conv, r.turn, r.role, r.text) for r in chat.rendered(chat.recover_roles(lines.drop("role"), chat.fit(lines))).collect())
    assert got == sorted((str(c), k, role, text) for c, k, role, text, *_ in rows)


def test_roles_are_found_where_markers_are_missing_or_wrong(spark):
    """Against what the markers alone say: a line has the role of the last marker."""
    df = spark.read.parquet("/root/testdata/sf0.1/conversations.parquet")
    r = chat.chat_report(df).where("held_out").selectExpr("sum(n_right) AS n", "sum(n_lines) AS of").first()
    lines = chat.transcript_lines(df).where("role is not null").collect()
    roles, right, total = {}, 0, 0
    held = {c for (c,) in df.select("conv_id").distinct().collect() if zlib.crc32(str(c).encode()) % chat.FOLDS == 0}
    names = {role: re.compile(chat.marker_pattern(chat.NAMES[role])) for role in chat.ROLES}
    for x in sorted(lines, key=lambda x: (x.conv, x.turn, x.i)):
        if x.conv in {str(c) for c in held}:
            roles[x.conv] = next((role for role in chat.ROLES if names[role].search(x.line)), roles.get(x.conv))
            right, total = right + (roles[x.conv] == x.role), total + 1
    assert total == r.of and r.n / r.of > max(0.93, right / total)


def test_long_turns_and_repeated_numbers_are_cut(spark, monkeypatch):
    """One turn of many lines, and many rows of one turn number: blocks stay small, and nothing is lost."""
    monkeypatch.setattr(chat, "BLOCK", 16)
    rows = [(1, 0, "user", "\n".join(f"line {k}?" for k in range(500)), "", ""), (1, 1, "assistant", "yes", "", "")] + [(2, 0, "user", f"again {k}", "", "") for k in range(300)] + [(3, None, "user", f"n {k}", "", "") for k in range(100)]
    df = spark.createDataFrame(rows, SCHEMA)
    lines = chat.transcript_lines(df)
    got = chat.recover_roles(lines.drop("role"), chat.fit(lines)).collect()
    assert sorted((r.conv, r.turn, r.i, r.line) for r in got) == sorted((r.conv, r.turn, r.i, r.line) for r in lines.collect())
    texts = [r.line for r in sorted((r for r in got if r.conv == "1"), key=lambda r: (r.turn, r.i))]
    assert len(texts) == 501 and all(r.role in chat.ROLES for r in got)


def test_odd_rows(spark):
    rows = [(1, 0, "user", None, "x", "y"), (1, 1, "assistant", "", "x", "y"), (None, None, None, "no role", "x", "y"), (2, 0, "user", "a", "x", "y"), (2, 0, "user", "a", "x", "y"), (3, 5, "robot", "w " * 50000, "x", "y")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = chat.chat_report(df)
    assert sum(r.n_lines for r in got.collect()) == len(rows)
    assert chat.chat_report(df.limit(0)).count() == 0


def test_whole_transcripts(spark):
    df = spark.createDataFrame([("t", "Human: hi\nthere\nAI: hello\nHuman: bye?"), ("u", None)], "conv string, text string")
    lines = chat.transcript_lines(spark.createDataFrame(conversations(), SCHEMA))
    got = [(r.role, r.text) for r in chat.rendered(chat.recover_roles(chat.text_lines(df), chat.fit(lines))).where("conv = 't'").orderBy("turn").collect()]
    assert got == [("user", "hi\nthere"), ("assistant", "hello"), ("user", "bye?")]
