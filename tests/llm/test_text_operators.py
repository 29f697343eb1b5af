"""BPE, quality rules, packing, media and toxicity against the library, brute force and round trips."""

import hashlib
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusloom.llm import bpe_trie, media, packing, quality_rules, toxicity

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, kept string, n_words string"  # extra columns with clashing names
ODD = [
    (1, None, "a", "b"), (2, "", None, None), (3, " \n\t ", "x", "y"), (None, "null id", "x", "y"), (4, "same text here", "x", "y"), (4, "same text here", "x", "y"),
    (5, "Don't WE'LL  é é​ﬁ İstanbul ΣΑΣ <|endoftext|> a\x1cb\x85c　d﻿", "x", "y"), (6, "word " * 30000, "x", "y"), (7, "x" * 5000, "x", "y"), (8, "line\r\nline\r\n\r\n", "x", "y"), (9, "😀👩‍👩‍👧 ٣ ² ½", "x", "y"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


texts = st.text(alphabet=st.sampled_from(list("abetionEXß é\n\t.,'s1½😀 ́Σİ<|>")), max_size=60)


@settings(max_examples=200, deadline=None)
@given(texts)
def test_trie_is_the_library(text):
    ids = Tokenizer.from_file(WORD) if not hasattr(test_trie_is_the_library, "t") else test_trie_is_the_library.t
    test_trie_is_the_library.t = ids
    got = [i for x in bpe_trie.coder(WORD).code([text])[0] for i in x[3]]
    assert got == ids.encode(text, add_special_tokens=False).ids
    assert bpe_trie.coder(WORD).decode(got) == ids.decode(got, skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(texts)
def test_byte_coder_is_the_library(text):
    t = test_byte_coder_is_the_library.__dict__.setdefault("t", Tokenizer.from_file(BYTE))
    got = np.frombuffer(packing.byte_coder(BYTE).encode(text), "<u4").tolist()
    assert got == t.encode(text, add_special_tokens=False).ids


def test_bpe_query_rows(spark, odd):
    t = Tokenizer.from_file(WORD)
    got = bpe_trie.bpe_round_trip(odd, WORD, outputs=True).collect()
    assert len(got) == len(ODD)
    want = Counter()
    for i, text, *_ in ODD:
        ids = t.encode(text or "", add_special_tokens=False).ids
        want[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert Counter(tuple(r)[:4] for r in got) == want
    back = {r.doc_id: r.decoded for r in bpe_trie.decode_ids(bpe_trie.bpe_round_trip(odd, WORD, outputs=True), WORD).collect()}
    assert back == {r.doc_id: r.decoded for r in got}
    assert bpe_trie.bpe_round_trip(odd.limit(0), WORD).count() == 0


def test_trie_asks_only_for_needed_states(monkeypatch):
    library, rng = Tokenizer.from_file(WORD), random.Random(4)
    parts = ["th", "ing", "on", "an", "er", "ciónn", "è", "eau", "ß", "schie", "re", "ou"]
    words = {"".join(rng.choices(parts, k=rng.randint(1, 6))) for _ in range(2000)} | {"".join(rng.choices("abeinost", k=n)) for n in (255, 256, 257, 5000)}
    coder, asked = bpe_trie.TrieCoder(WORD), Counter()
    real = bpe_trie.TrieCoder.last_token
    monkeypatch.setattr(bpe_trie.TrieCoder, "last_token", lambda self, word, end, states: asked.update([word[:end]]) or real(self, word, end, states))
    short = {coder.symbols(w): w for w in words if len(w) < 200}
    got = coder.encode_words(short)
    assert all(list(got[s]) == library.encode(w, add_special_tokens=False).ids for s, w in short.items())
    nodes = {s[:k] for s in short for k in range(1, len(s) + 1)}
    assert set(asked) <= nodes and max(asked.values()) <= 2 and sum(asked.values()) < 0.8 * len(nodes)
    for w in words:
        assert list(coder.encode_words([coder.symbols(w)])[coder.symbols(w)]) == library.encode(w, add_special_tokens=False).ids


def test_memory_generations(monkeypatch):
    for name in ("MEMO_WORDS", "MEMO_CHUNKS"):
        monkeypatch.setattr(bpe_trie, name, 20)
    library, coder, rng = Tokenizer.from_file(WORD), bpe_trie.TrieCoder(WORD), random.Random(5)
    marks = ["", ",", "...", "'s", "'", "%%%", "$1", "é!", "÷", "\x00", "_", "²", "ŉ", "<|endoftext|>", "\x85", "日本"]
    for _ in range(60):
        lot = [" ".join("".join(rng.choices("aénßtoƀ", k=rng.randint(0, 3))) + rng.choice(marks) + rng.choice(["", "re"]) for _ in range(12)) for _ in range(4)]
        assert [[i for x in text for i in x[3]] for text in coder.code(lot)] == [library.encode(t, add_special_tokens=False).ids for t in lot]


def test_every_code_point_is_the_library():
    library, coder = Tokenizer.from_file(WORD), bpe_trie.TrieCoder(WORD)
    newest = [0x88F, 0xC5C, 0xCDC, 0x1C89, 0xA7CB, 0xA7D2, 0x16EB6]  # letters of Unicode 16 and 17, of which Python, regex and the library may know different ones
    lot = [f"a{chr(k)}b {chr(k)}%{chr(k)} x" for k in [*newest, *range(1, 0xD800, 7), *range(0xE000, 0x110000, 101)]]
    assert [[i for x in text for i in x[3]] for text in coder.code(lot)] == [e.ids for e in library.encode_batch(lot, add_special_tokens=False)]


def brute_quality(text):
    words = [w for w in __import__("re").findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]
    threes = Counter(zip(words, words[1:], words[2:]))
    again = set()
    for k in range(len(words) - 2):
        if threes[tuple(words[k : k + 3])] > 1:
            again |= {k, k + 1, k + 2}
    lines, dup, seen = (text or "").split("\n"), 0, set()
    for line in lines:
        if __import__("re").search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), dup, len(again), len(words) < 50 or 100 * len(again) > 50 * len(words)


def test_quality_base(spark, odd):
    rng = random.Random(1)
    rows = [(100 + k, " ".join(rng.choice(["a", "b", "cc", "#d", "e\n"]) for _ in range(rng.randint(0, 90))), "x", "y") for k in range(200)]
    df = odd.union(spark.createDataFrame(rows, SCHEMA))
    got = Counter(tuple(r)[:7] for r in quality_rules.quality_report(df).collect())
    assert got == Counter((i, *brute_quality(t)) for i, t, *_ in ODD + rows)
    assert quality_rules.quality_report(odd.limit(0)).count() == 0


def test_quality_verdict_has_no_order(spark):
    good = " ".join(f"palabra{k % 97}x{k}" for k in range(200))
    docs = spark.createDataFrame([(1, good, "a", "b"), (2, " ".join(w + "###" for w in good.split()), "a", "b"), (3, good.upper().replace(" ", "!! "), "a", "b"), (4, "a b c " * 60, "a", "b")], SCHEMA)
    n = len(quality_rules.OWN)
    for order in (None, list(range(n)), list(range(n))[::-1]):
        assert {r.doc_id: r.kept for r in quality_rules.quality_report(docs, order=order).collect()} == {1: True, 2: False, 3: False, 4: False}
    kept = quality_rules.filter_quality(docs)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1]


def test_packing(spark, odd):
    t = Tokenizer.from_file(BYTE)
    got = packing.pack(odd, BYTE).collect()
    ids = {i: t.encode(text or "", add_special_tokens=False).ids + [2] for i, text, *_ in ODD}
    held = Counter()
    for r in got:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        assert r.length == 1024 or r.piece == 0
        held[r.doc_id] += r.length
    assert held == Counter({i: len(x) * sum(o[0] == i for o in ODD) for i, x in ids.items()})
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(bins) == -(-sum(held.values()) // 1024)
    assert packing.pack(odd.limit(0), BYTE).count() == 0


def test_fullest_is_brute_force():
    rng = random.Random(2)
    for _ in range(200):
        counts = {rng.randint(1, 12): rng.randint(1, 3) for _ in range(rng.randint(1, 5))}
        room, sums = rng.randint(0, 30), {0}
        for x, n in counts.items():
            sums = {s + k * x for s in sums for k in range(n + 1)}
        found = packing.fullest(counts, sorted(counts, reverse=True), room)
        assert sum(found) == max(s for s in sums if s <= room) and all(found.count(x) <= counts[x] for x in found)


def test_plan_uses_all_and_few_bins():
    rng = random.Random(3)
    histogram = Counter(rng.randint(1, 1024) for _ in range(3000))
    plan = packing.minimum_slack_plan(histogram)
    used = Counter()
    for times, bin_ in plan:
        assert sum(bin_) <= 1024
        for x in bin_:
            used[x] += times
    assert used == histogram
    assert sum(t for t, _ in plan) <= 1.03 * -(-sum(k * v for k, v in histogram.items()) // 1024)


def test_media_rows(spark, odd):
    got = media.text_media(odd).collect()
    for r in got:
        raw = next((t or "").encode() for i, t, *_ in ODD if i == r.doc_id)
        payload = raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert np.load(__import__("io").BytesIO(r.tile)).shape == media.TILE
    assert len(got) == len(ODD) and media.text_media(odd.limit(0)).count() == 0


@pytest.mark.parametrize("shape", [(1, 1), (7, 5), (64, 64), (9, 200)])
def test_image_round_trips(shape):
    rng = np.random.default_rng(4)
    gray, color = rng.integers(0, 256, shape, dtype=np.uint8), rng.integers(0, 256, (*shape, 3), dtype=np.uint8)
    assert (media.decode(media.encode_pgm(gray)) == gray).all() and (media.decode(media.encode_bmp(gray)) == gray).all()
    assert (media.decode(media.encode_ppm(color)) == color).all() and (media.decode(media.encode_bmp(color)) == color).all()


def test_plain_netpbm_and_bad_files(spark):
    assert media.decode(b"P2 # c\n2 1\n# d\n15\n0 15\n").tolist() == [[0, 255]]
    assert media.decode(b"P1\n2 2\n0 1\n1 0\n").tolist() == [[255, 0], [0, 255]]
    assert media.decode(b"P4\n9 1\n\xff\x80").tolist() == [[0] * 9]
    df = spark.createDataFrame([(1, bytearray(media.encode_pgm(np.zeros((4, 4), np.uint8)))), (2, bytearray(b"P5 9 9 255 x")), (3, None), (4, bytearray(b"BM"))], "id long, media binary")
    assert [r.media_id for r in media.media_tiles(df).collect() if r.dhash is not None] == [1]
    bad = [b"P5 99999999999 999999999 255\n", b"P5 0 0 255\n", b"P5 -1 4 255\nxxxx", b"P5 4 4 0\n" + bytes(16), b"P2 2 1 255 99999999999999999999999 1", media.encode_bmp(np.zeros((3, 3), np.uint8))[:18] + bytes(8), b"P6 2 2 70000\n" + bytes(24)]
    df = spark.createDataFrame([(k, bytearray(b)) for k, b in enumerate(bad)], "id long, media binary")
    assert [(r.width, r.height, r.tile, r.dhash) for r in media.media_tiles(df).collect()] == [(None,) * 4] * len(bad)


def test_difference_hash_by_hand():
    """Of the text's tile: each bit says whether a cell's mean is above that of its left neighbour."""
    text = "The quick brown fox " * 90
    n, data = media.stored(text)
    image, tile, mark = media.features(data)
    assert n == len(text) and image.tobytes()[:n] == text.encode()
    h, w = image.shape
    mean = np.empty(media.TILE)
    for r in range(8):
        for c in range(9):  # exact areas, cell by cell
            y0, y1, x0, x1 = r * h / 8, (r + 1) * h / 8, c * w / 9, (c + 1) * w / 9
            weight = np.outer([max(0, min(y + 1, y1) - max(y, y0)) for y in range(h)], [max(0, min(x + 1, x1) - max(x, x0)) for x in range(w)])
            mean[r, c] = np.clip(np.rint((weight * image).sum() / weight.sum()), 0, 255)
    bits = "".join(str(int(mean[r, c + 1] > mean[r, c])) for r in range(8) for c in range(8))
    assert mark == f"{int(bits, 2):016x}"


def test_hash_sample_is_bounded_and_whole_below_the_bound(spark):
    df = spark.createDataFrame([(k % 700, k) for k in range(2000)], "doc_id long, k int")
    for rows in (5, 100, 1999, 2000, 10**6):
        got = toxicity.hash_sample(df, "doc_id", rows).count()
        assert got <= rows and (got == 2000 if rows >= 2000 else rows < 50 or got > rows / 2)


def test_area_resize_is_the_mean():
    image = np.random.default_rng(5).integers(0, 256, (16, 18)).astype(np.uint8)
    want = image.reshape(8, 2, 9, 2).mean(axis=(1, 3))
    assert np.abs(media.area_resize(image, (8, 9)) - want).max() <= 0.5


def test_toxic_clauses():
    g = toxicity.Grammar({})
    kind = lambda text: [k for k, v in zip(toxicity.KINDS, g.features(text)) if v]
    assert kind("what an idiot.") == ["plain"]
    assert kind("you are an idiot") == ["aimed"]
    assert kind("this is not stupid") == ["negated"]
    assert kind("he said it was trash.") == ["reported"] and kind("he said so. it was trash") == ["plain"]
    assert kind("i will kill it") == ["threat"] and kind("they kill time") == ["threat"] and kind("kill time") == ["bare_threat"]
    assert kind("") == [] and kind("idiotic") == []


def test_toxicity_held_out(spark, odd):
    rng = random.Random(6)
    plain = [f"palabra{k}" for k in range(300)]
    docs, labels = [], []
    for k in range(600):
        words = [rng.choice(plain) for _ in range(60)]
        toxic = k % 5 == 0
        for _ in range(3 * toxic):
            words.insert(rng.randrange(60), rng.choice(["idiot", "scum", "zorple"]))
        docs.append((k, " ".join(words), "x", "y"))
        labels.append((k, 1, int(toxic)))
    df, known = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(df, known)
    assert "zorple" in model.weights
    got = {r.doc_id: r for r in toxicity.score_toxicity(df, model).collect()}
    held = [k for k in got if got[k].held_out]
    assert held and all(got[k].held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k in got)
    assert sum(got[k].predicted == labels[k][2] for k in held) >= 0.98 * len(held)
    assert toxicity.score_toxicity(odd, model).count() == len(ODD)
    assert all(0 <= r.score <= 1 for r in toxicity.score_toxicity(odd, toxicity.fit(odd, known.limit(0))).collect())
    assert toxicity.score_toxicity(odd.limit(0), model).count() == 0
    assert [r.doc_id for r in toxicity.filter_toxicity(df, model).where("doc_id < 6").collect()] == [1, 2, 3, 4]


def test_toxicity_of_rare_languages(spark):
    """A language with 3 % of the toxic texts has its words learned, and as many words as there are."""
    rng = random.Random(7)
    plain, bad = (["".join(w) for w in itertools.product(x, "abcdefghijklmnop", "aeioutlnrs")] for x in (["pala", "bra"], ["zor", "ple"]))  # 320 each
    docs, labels = [], []
    for k in range(1500):
        words = [rng.choice(plain) for _ in range(60)]
        toxic = k % 5 == 0
        rare = k % 100 == 0  # 15 of the 300 toxic texts
        for _ in range(3 * toxic):
            words.insert(rng.randrange(60), rng.choice(["vrolk", "brimt"]) if rare else rng.choice(bad))
        if toxic and not rare:
            words += bad[k // 5 % 4 :: 4]  # each in many texts
        docs.append((k, " ".join(words), "x", "y"))
        labels.append((k, 1, int(toxic)))
    model = toxicity.fit(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert {"vrolk", "brimt"} <= {*model.weights}
    assert not {*plain} & {*model.weights}
    assert {*bad} <= {*model.weights}
    got = {r.doc_id: r for r in toxicity.score_toxicity(spark.createDataFrame(docs, SCHEMA), model).collect()}
    held = [k for k in got if got[k].held_out]
    assert any(k % 100 == 0 for k in held) and all(got[k].predicted == labels[k][2] for k in held)


def test_toxic_documents_of_each_language_are_caught(spark):
    """Held-out labelled rows of sf0.1: recall by language, and clean rows left alone."""
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = toxicity.toxicity(spark, docs, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    got = {(r.lang, r.toxic): (r.n, r.hit) for r in rows.groupBy("lang", "toxic").agg(F.count("*").alias("n"), F.sum("predicted").alias("hit")).collect()}
    for (lang, toxic), (n, hit) in got.items():
        assert hit >= 0.85 * n if toxic else hit <= 0.01 * n, (lang, toxic, n, hit)
    assert {lang for lang, _ in got} == {"en", "fr", "de", "es"}


def test_clause_sums_are_those_of_plain_rules():
    """The composed machine against windows of words read plainly."""
    rng = random.Random(11)
    classes = toxicity.base_classes()
    words = ["idiot", "kill", "will", "you", "not", "said", "tree", "scum", "tree", "house"]
    ends = ["", "", "", "", ",", "."]
    tool = toxicity.Grammar({"scum": 2.5})
    for _ in range(300):
        raw = [(rng.choice(words), rng.choice(ends)) for _ in range(rng.randint(1, 25))]
        want = dict.fromkeys(toxicity.KINDS, 0.0)
        for at, (w, _) in enumerate(raw):
            c = classes[w] if w in classes else toxicity.OTHER
            if c not in (toxicity.INSULT, toxicity.THREAT):
                continue
            start = next((k + 1 for k in range(at - 1, -1, -1) if raw[k][1]), 0)  # the clause
            sentence = next((k + 1 for k in range(at - 1, -1, -1) if raw[k][1] == "."), 0)
            seen = lambda word, reach: word in [x for x, _ in raw[max(start, at - reach + 1) : at]]  # noqa: B023, E731
            if "said" in [x for x, _ in raw[sentence:at]]:
                kind = "reported"
            elif seen("not", 4):
                kind = "negated"
            elif c == toxicity.THREAT:
                kind = "threat" if seen("will", 4) or seen("you", 5) else "bare_threat"
            else:
                kind = "aimed" if seen("you", 5) else "plain"
            want[kind] += 2.5 if w == "scum" else 1.0
        assert tool.features(" ".join(w + e for w, e in raw)) == [want[k] for k in toxicity.KINDS]
