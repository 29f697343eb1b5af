"""Substring dedup, SimHash, WARC, language model and pipeline against brute force and exact round trips."""

import hashlib
import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash

import corpus_pipeline
from corpusloom.llm import attention_lm as lm
from corpusloom.llm import simhash, substring_dedup, tables, warc
from tests.compare import difference

SCHEMA = "doc_id long, text string, source string, covered string, first string, fp string"


def rows(texts):
    return [(i, t, "s", "c", "f", "p") for i, t in texts]


def passages(seed, n):
    rng = random.Random(seed)
    base = [" ".join(f"{rng.choice('abcdefghij')}{rng.randint(0, 9)}" for _ in range(300)) for _ in range(6)]
    out = []
    for i in range(n):
        w = rng.choice(base).split()
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = f"edit{rng.randint(0, 50)}"
        a = rng.randint(0, 150)
        out.append((i, " ".join(w[a : a + rng.randint(10, 200)] + rng.choice(base).split()[: rng.randint(0, 90)])))
    return out + [(n, None), (n + 1, ""), (n + 2, "x " * 500), (n + 3, "x " * 49), (n + 4, "x " * 120), (None, base[0])]


def brute_dedup(texts):
    words = {i: (t or "").encode().split() for i, t in texts}
    seen = {}
    for i, w in words.items():
        for s in range(len(w) - 49):
            if i is not None:
                seen[tuple(w[s : s + 50])] = min(seen.get(tuple(w[s : s + 50]), i), i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for s in range(len(w) - 49):
            if i is not None and seen[tuple(w[s : s + 50])] < i:
                gone[s : s + 50] = [True] * 50
        out[i] = (len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("shard", [256, 3])
def test_substring_dedup(spark, shard, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SHARD", shard)
    texts = passages(shard, 120)
    df = spark.createDataFrame(rows(texts), SCHEMA)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.dedup_report(df).collect()}
    assert got == brute_dedup(texts)


def test_remove_repeats_keeps_columns(spark):
    texts = passages(9, 60)
    df = spark.createDataFrame(rows(texts), SCHEMA)
    out = substring_dedup.remove_repeats(df)
    assert out.columns == df.columns
    want = brute_dedup(texts)
    got = {r.doc_id: r.text for r in out.collect()}
    for i, t in texts:
        assert hashlib.sha256(b" ".join((got[i] or "").encode().split())).hexdigest() == want[i][2]
        assert want[i][1] or got[i] == t  # untouched texts keep their white space
    assert substring_dedup.remove_repeats(df.limit(0)).count() == 0


def test_automaton_is_brute_force():
    rng = random.Random(3)
    for _ in range(100):
        held = [[rng.randint(0, 2) for _ in range(rng.randint(0, 12))] for _ in range(3)]
        a = substring_dedup.SuffixAutomaton()
        for h in held:
            a.add(h)
        q = [rng.randint(0, 3) for _ in range(15)]
        inside = {tuple(h[i:j]) for h in held for i in range(len(h)) for j in range(i, len(h) + 1)}
        assert a.match(q) == [max(n for n in range(i + 2) if tuple(q[i + 1 - n : i + 1]) in inside or n == 0) for i in range(len(q))]


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) > 2 else [b" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def union(ids, linked):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_simhash(spark):
    rng = random.Random(4)
    base = [f"W{k}" for k in range(400)]
    texts = [(k, " ".join(base[: 300 + rng.randint(0, 8)]) if k % 3 else " ".join(rng.choice(base) for _ in range(50))) for k in range(90)] + [(90, None), (91, ""), (92, "One"), (93, "one"), (94, "two words"), (None, "x"), (None, None)]
    df = spark.createDataFrame(rows(texts), SCHEMA)
    got = simhash.simhash_components(df).collect()
    marks = {i: brute_fingerprint(t) for i, t in texts if i is not None}
    linked = [(a, b) for a in marks for b in marks if a < b and (marks[a] ^ marks[b]).bit_count() <= 3]
    want = union(marks, linked)
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got if r.doc_id is not None) == Counter((i, f"{marks[i]:016x}", want[i]) for i in marks)
    assert len(got) == len(texts)
    kept = simhash.one_of_each(df)
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted({*want.values()}) and kept.where("doc_id is null").count() == 2
    assert simhash.simhash_components(df.limit(0)).count() == 0


def test_split_buckets_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LANES", 5)
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    fps = sorted({centre} | {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(60)} | {rng.getrandbits(64) for _ in range(60)})
    nodes = spark.createDataFrame([(simhash.signed(f), k) for k, f in enumerate(fps)], "fp long, doc long")
    got = union(range(len(fps)), [(r.a, r.b) for r in simhash.links(nodes).collect()])
    assert got == union(range(len(fps)), [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3])


def test_near_lanes():
    rng = np.random.default_rng(6)
    fps = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    fps[100:] = fps[:100] ^ (np.uint64(1) << rng.integers(0, 64, 100).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 100).astype(np.uint64))
    planes = simhash.bit_planes(fps)
    for shift in (1, 63, 64, 65, 100, 199):
        ok = np.ones(200 - shift, bool)
        want = [i for i in range(200 - shift) if int(fps[i] ^ fps[i + shift]).bit_count() <= 3]
        assert simhash.near_lanes(planes, shift, simhash.lanes(ok, planes.shape[1])).tolist() == want


BIG = "x" * 120
EVIL = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n" + BIG
PAGES = [(1, "http://a", "<p>"), (2, "http://b\r\nX: y", BIG), (3, None, BIG), (4, "u", None), (5, "u", EVIL), (6, "u", EVIL), (7, "u", "\r\n\r\n"), (8, "u", "\r\n\r\r\n\r\n\r\n"), (9, "u", "tail\r\n"), (10, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc"), (None, "u", BIG), (11, "u", "é" * 60 + "\n"), (2, "again", BIG), (12, "u", "\r"), (13, "u", "\n\r\n\r\n\r")]


@pytest.mark.parametrize("parts", [1, 3])
def test_warc_round_trip(spark, parts):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(parts)
    got = warc.warc_round_trip(df).collect()
    least = {}
    for i, _, h in PAGES:
        if i is not None and len((h or "").encode()) >= 100:
            least[h] = min(i, least.get(h, i))
    want = Counter()
    for i, _, h in PAGES:
        b = (h or "").encode()
        later = i is not None and h in least and i > least[h]
        want[i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if later else "response", least[h] if later else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert warc.warc_round_trip(df.limit(0)).count() == 0


PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_lm(spark):
    rng = random.Random(7)
    texts = [(k, " ".join(rng.choice(["the", "red", "fox", "Runs", f"n{k}", "zß"]) for _ in range(rng.randint(0, 80)))) for k in range(60)] + [(60, None), (61, ""), (61, ""), (62, "w" * 3000), (None, "the red fox")]
    df = spark.createDataFrame(rows(texts), SCHEMA)
    got = lm.lm_scores(df, PATH).collect()
    training = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2
    counts = Counter()
    for i, t in texts:
        if training(i):
            counts.update([*(t or "").encode().lower().split(), None])
    total, distinct, want = sum(counts.values()), len(counts), Counter()
    for i, t in texts:
        words = [*(t or "").encode().lower().split(), None]
        want[i, not training(i), len(words), sum(counts[w] > 0 for w in words), total, round(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words), 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert lm.lm_scores(df.limit(0), PATH).count() == 0


def _rows(n=3000):
    return [(lm.FIRST, i, 1000 - i % 997, 3) for i in range(n)] + [(lm.LATER, i, 5, 2) for i in range(n)] + [(i, i + 1, 4, 2) for i in range(n)] + [(i, lm.STOP, 7, 2) for i in range(n)]


def _model():
    """Parameters in double precision, and windows over 40 words of 1 to 4 ids each."""
    p = {k: w.astype(np.float64) for k, w in lm.initial(lm.Vocabulary.of(_rows(), 50, 50257)).items()}
    rng = np.random.default_rng(8)
    for k in ("cw", "mw"):
        p[k] = rng.standard_normal(p[k].shape) * 0.2
    lengths = rng.integers(1, 5, 40)
    flat, first = rng.integers(0, lm.INPUTS + 1, lengths.sum()), rng.integers(0, lm.SMALL + 1, 40)
    at, ok, targets, scored = lm.windows([rng.integers(0, 40, 70)])[:4]
    return p, flat, lengths, (at, ok, first[targets], scored)


def _scores(p, flat, lengths, w):
    return lm.log_probabilities(p, lm.word_vectors(p["embed"], flat, lengths), *w)


def test_gradient():
    p, flat, lengths, w = _model()
    loss = lambda: -_scores(p, flat, lengths, w).sum() / w[3].sum()
    g = lm.gradient(p, flat, lengths, *w)
    rng = np.random.default_rng(9)
    for name in p:
        at = (int(flat[lengths[: int(w[0][1, 10])].sum()]), 3) if name == "embed" else tuple(int(rng.integers(0, s)) for s in p[name].shape)
        old = p[name][at]
        p[name][at] = old + 1e-4
        up = loss()
        p[name][at] = old - 1e-4
        down = loss()
        p[name][at] = old
        assert abs((up - down) / 2e-4 - g[name][at]) < 1e-7


def test_attention_is_that_of_plain_loops():
    p, flat, lengths, (at, ok, targets, scored) = _model()
    got, ends = _scores(p, flat, lengths, (at, ok, targets, scored)), np.cumsum(lengths)
    vector = lambda w: sum(p["embed"][i] for i in flat[ends[w] - lengths[w] : ends[w]])
    soft = lambda z: np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    for i in range(len(at)):
        x = [vector(at[i, j]) + p["place"][j] for j in range(lm.PLACES)]
        for j in range(lm.CONTEXT, lm.PLACES):
            if not scored[i, j - lm.CONTEXT]:
                continue
            seen = [m for m in range(j + 1) if ok[i, m]]
            a = soft(np.array([(x[j] @ p["q"]) @ (x[m] @ p["k"]) / math.sqrt(lm.WIDTH) for m in seen]))
            h = x[j] + sum(w * (x[m] @ p["v"]) for w, m in zip(a, seen)) @ p["o"]
            t = int(targets[i, j - lm.CONTEXT])
            c = t // lm.MEMBERS
            want = math.log(soft(h @ p["cw"] + p["cb"])[c]) + (math.log(soft(h @ p["mw"][c] + p["mb"][c])[t % lm.MEMBERS]) if t < lm.SMALL else 0)
            assert abs(want - got[i, j - lm.CONTEXT]) < 1e-5


def test_each_word_is_scored_once_and_causally():
    p, flat, lengths, _ = _model()
    words = np.arange(99) % 39 + 1
    score = lambda words: (lambda at, ok, targets, scored, _: (_scores(p, flat, lengths, (at, ok, targets, scored))[scored], targets[scored]))(*lm.windows([words]))
    full, targets = score(words)
    assert targets.tolist() == [*words, 0]
    other, _ = score(np.append(words[:60], words[60:][::-1]))
    assert np.allclose(full[:60], other[:60]) and not np.allclose(full[60:], other[60:])


def test_words_of_one_first_id_share_their_probability():
    """The dictionary's words and all spelled ones together: one, but for the spelled ones that the dictionary holds."""
    speller = lm.Speller(PATH)
    counts = {"then": 5, "thenx": 2, "thenxx": 1, "zebra": 9}
    rows, after = Counter(), Counter()
    for w, c in counts.items():
        ids, prev = [*speller.encode([w])[0].tolist(), lm.STOP], lm.FIRST
        for i in ids:
            for q in (prev,) if prev == lm.FIRST else (prev, lm.LATER):
                rows[q, i] += c
                after[q, i] += 1
            prev = i
    v = lm.Vocabulary.of([(*k, n, after[k]) for k, n in rows.items()], 3, speller.size)
    d = lm.Dictionary.of(counts, v, speller)
    ids, lengths = speller.encode([*counts])
    first, spelled = ids[np.cumsum(lengths) - lengths], np.exp(v.spelled(ids, lengths))
    for i in set(first):
        assert abs(np.exp(d.tail[first == i]).sum() + np.exp(d.escape[i]) * (1 - spelled[first == i].sum()) - 1) < 1e-9
    one = speller.encode(["then"])[0]  # what follows an id, over the whole vocabulary
    every = np.append(np.arange(speller.size), speller.size)
    keys = (one[-1] << 32) + every
    share = np.where(np.isin(keys, v.pairs), 0, v.later[every] - v.held[one[-1]])
    known = np.isin(v.pairs, keys)
    assert abs(np.exp(share[share != 0]).sum() + np.exp(v.pair_log[known] - v.held[one[-1]]).sum() - 1) < 1e-6


def test_words_are_those_of_bytes():
    import pyarrow as pa

    texts = ["", " ", "a", " A  b\t\x0bC\x0c\r\nd ", "\u00a0x \x1cy\u2003", "\u00c9 \u0130I", "\n\n", "z " * 50]
    words, lengths = lm.split_words(pa.array(texts))
    want = [t.encode().lower().split() for t in texts]
    assert [w.encode() for w in words.to_pylist()] == [w for t in want for w in t] and lengths.tolist() == [len(t) for t in want]


def test_slices_hold_all_rows(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(lm, "SLICE_BYTES", 10)
    texts = ["abc", "", "x" * 40, "y" * 9, "", "zz", "w" * 10, ""]
    batch = pa.record_batch({"k": list(range(8)), "text": texts})
    parts = list(lm.slices(iter([batch, batch.slice(0, 0)])))
    assert [t for p in parts for t in p.column(1).to_pylist()] == texts and len(parts) > 2


def test_word_vectors_and_their_gradient_are_plain_sums():
    rng = np.random.default_rng(12)
    lengths = np.concatenate([rng.integers(1, 5, 2000), [lm.NEAR_IDS, lm.NEAR_IDS + 1, 90, 1]])
    embed, flat = rng.standard_normal((lm.INPUTS + 1, lm.WIDTH)).astype(np.float32), rng.integers(0, lm.INPUTS + 1, lengths.sum()).astype(np.int16)
    plain = lambda: np.add.reduceat(embed[flat], np.cumsum(lengths) - lengths, axis=0)
    for some in (lengths, lengths[:1], lengths[:0]):
        assert np.allclose(lm.word_vectors(embed, flat[: some.sum()], some), plain()[: len(some)], atol=1e-4)
    dx, at, want = rng.standard_normal((5000, lm.WIDTH)), rng.integers(0, len(lengths), 5000), np.zeros((lm.INPUTS + 1, lm.WIDTH))
    words = np.split(flat, np.cumsum(lengths)[:-1])
    for row, w in zip(dx, at):
        np.add.at(want, words[w], row)
    assert np.allclose(lm.embed_gradient(dx, at, flat, lengths), want)

    def seconds(fn):
        start = time.perf_counter()
        fn()
        return time.perf_counter() - start

    spent = [(seconds(lambda: lm.word_vectors(embed, flat, lengths)), seconds(plain)) for _ in range(100)]
    own, reduceat = (min(x) for x in zip(*spent))
    assert own < 0.85 * reduceat  # each training step makes these sums anew


def test_targets_without_members_have_a_gradient():
    p, flat, lengths, (at, ok, targets, scored) = _model()
    g = lm.gradient(p, flat, lengths, at, ok, np.full_like(targets, lm.SMALL), scored)
    assert not g["mw"].any() and not g["mb"].any() and g["cb"][-1] < 0 and all(np.isfinite(x).all() for x in g.values())


def test_words_are_encoded_as_alone():
    speller = lm.Speller(PATH)
    words = [w for w in ["the", "it's", "don't.", "zß", "x\u00a0y", "\u2003", "a,b", "…", "12ab", "\x1cq", "'s", "日本語", "e\u0301"]]
    for some in (words, words[:4], words[6:9], [words[4]], []):
        ids, lengths = speller.encode(some)
        assert ids.tolist() == [i for w in some for i in speller.plain(" " + w)] and len(lengths) == len(some)


def test_windows_of_many_texts_are_those_of_each():
    rng = np.random.default_rng(10)
    texts = [rng.integers(0, 50, n) for n in (0, 1, 17, 18, 19, 100)]
    *whole, owner = lm.windows(texts)
    for k, t in enumerate(texts):
        for a, b in zip(whole, lm.windows([t])[:4]):
            ok = lm.windows([t])[1] if a.shape[1] == lm.PLACES else lm.windows([t])[3]
            assert (a[owner == k][ok] == b[ok]).all()


def _told(spark):
    vocabulary = lm.Vocabulary.of(_rows(), 50, lm.Speller(PATH).size)
    return spark.sparkContext.broadcast((vocabulary, lm.Dictionary.of({"red": 3}, vocabulary, lm.Speller(PATH))))


def test_every_training_document_is_trained_on(spark):
    told = _told(spark)
    before = lm.packed(lm.initial(told.value[0]))
    ids = [i for i in range(20) if zlib.crc32(str(i).encode()) % 7 != 2]
    for i in [*ids[:4], None]:
        df = spark.createDataFrame([(i, "the red fox runs")], "doc_id long, text string")
        assert (lm.packed(lm.train(df, PATH, told)) != before).any()
    df = spark.createDataFrame([(i,) for i in [*range(200), None]], "doc_id long")
    read = Counter(r.doc_id for k in range(lm.ROUNDS) for r in lm.share(df, k).collect())
    assert read == Counter(i for i in [*range(200), None] if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2)


def test_vectors_are_summed_level_by_level(spark):
    df = spark.range(0, 300, 1, 40).selectExpr("id + 1 AS tokens", "cast(null AS binary) AS flat").drop("flat")

    def vectors(batches):
        import pyarrow as pa

        for b in batches:
            n = b.column(0).to_pylist()
            yield pa.record_batch([pa.array(n, pa.int64()), pa.array([np.array([k, 2], np.float32).tobytes() for k in n], pa.binary())], names=["tokens", "flat"])

    r = lm.total_of(df.mapInArrow(vectors, "tokens long, flat binary")).collect()
    assert len(r) == 1 and r[0].tokens == 45150 and np.frombuffer(r[0].flat, np.float32).tolist() == [45150, 600]


def test_most_frequent_keeps_the_limit(spark):
    df = spark.createDataFrame([(k, c) for k, c in enumerate([100] * 3 + [50] * 4 + [1] * 90)], "k int, c long")
    for limit, n in ((2, 0), (3, 3), (6, 3), (7, 7), (96, 7), (97, 97), (1000, 97)):
        assert lm.most_frequent(df, df.c, limit).count() == n


def test_a_distribution_sums_to_one():
    p, flat, lengths, _ = _model()
    at, ok, targets, scored = lm.windows([np.array([5, 9, 30])])[:4]
    total = sum(np.exp(_scores(p, flat, lengths, (at, ok, np.full_like(targets, t), scored))[scored][2]) for t in range(lm.SMALL + 1))
    assert abs(total - 1) < 1e-6


def test_the_model_beats_the_base_on_held_out_rows(spark):
    df = tables.op6_lm(spark, "/root/testdata/sf0.1").where("held_out")
    r = df.selectExpr("sum(score) / sum(n_tokens) AS model", "sum(base_score) / sum(n_tokens) AS base").first()
    assert r.model > r.base + 0.05


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, None
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name != "packing":
            assert out.columns == columns
        docs, before = corpus_pipeline.written(out, name), docs
        if name in ("quality_rules", "toxicity", "simhash"):
            ids = {r.doc_id for r in docs.select("doc_id").collect()}
            assert ids < {r.doc_id for r in before.select("doc_id").collect()} or name == "simhash"
    assert {r.doc_id for r in docs.select("doc_id").collect()} == {r.doc_id for r in before.select("doc_id").collect()}


@pytest.mark.parametrize("name", sorted(tables.ORACLE))
def test_same_as_sql(spark, name):
    assert difference(spark, "/root/testdata/sf0.001", tables.QUERIES[name], tables.ORACLE[name]) == ""
