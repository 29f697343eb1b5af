"""BPE encoding and decoding by prefix-sharing trie traversal.

The distinct words of a batch, sorted, are a trie in depth-first order: what two neighbours share is the path that stays
on the stack. Each node carries one state, the last token of its prefix's encoding. A token is the last one of a prefix
exactly if it ends there and the merges never join it with the last token before it, so a node's state follows from the
states on its path, and an encoding of a shared prefix is made once. A word's ids are read back along the states, and a
state is only worked out when a word's end or a later state asks for it.

Normalising and splitting are the tokenizer file's own. Null or empty text: no ids, an empty decoded text. Repeated rows:
equal values. A null doc_id is returned as it is. Added tokens' strings in a text become their ids, as the library does.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from corpusloom.llm.common import id_text, row_map

#: Chunks and words that a worker remembers, and as many of the generation before.
MEMO_CHUNKS, MEMO_WORDS = 300_000, 200_000
#: Symbols of a word above which its states are made in order, as asking back from its end would nest too deep.
DEEP = 256
#: The final symbol of a word lies this much higher than the same symbol inside it.
FINAL = 0xF0000
#: White space on which Python and the tokenizer may not agree; such texts go through the library's own splitter.
ODD_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0 ᠎ -‏    　﻿İΣ]")
#: A chunk that is Latin letters and then ASCII marks without an apostrophe, so two words at most.
PLAIN = re.compile(r"([a-z\u00df-\u00f6\u00f8-\u024f]+)([!-&(-/:-@\[-`{-~]*)").fullmatch


@lru_cache(maxsize=1)
def byte_symbols() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def newer_letters(normalize: Callable[[str], str]) -> re.Pattern[str]:
    """The code points that Python's Unicode leaves unassigned and the library's normaliser changes."""
    lacking = [c for c in map(chr, range(0x80, 0x110000)) if unicodedata.category(c) == "Cn"]
    changed = [a for a, b in zip(lacking, normalize("|".join(lacking)).split("|")) if a != b]
    return re.compile("[" + "".join(changed) + "]" if changed else "(?!)")


class TrieCoder:
    """Encoder and decoder for a word-final BPE tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        model = data["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.names = {i: t for t, i in model["vocab"].items()} | {t["id"]: t["content"] for t in data["added_tokens"]}
        self.added = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.token_of = {self._folded(t): i for t, i in model["vocab"].items()}
        tails: dict[str, set[int]] = {}
        for t in self.token_of:
            tails.setdefault(t[-2:], {1}).add(len(t))
            if len(t) > 2:
                tails.setdefault(t[-3:], {1, 2} if t[-2:] in self.token_of else {1}).add(len(t))
        #: Lengths, falling, of the tokens that end in two or three given symbols.
        self.lengths = {t: tuple(sorted(n, reverse=True)) for t, n in tails.items()}
        self.decimal = {i: b"%d" % i for i in self.names}
        self.spelled = {i: t.encode() for i, t in self.names.items()}
        self.rank, self.left, self.right, self.merge = {}, {}, {}, {}
        for r, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            x, y = self._folded(a), self._folded(b)
            self.merge.setdefault((x, y), r)
            if x + y not in self.rank:
                self.rank[x + y], self.left[x + y], self.right[x + y] = r, x, y
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.newer = newer_letters(self.normalizer.normalize_str).search
        pattern = data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern).findall
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")").split
        self.table = byte_symbols()
        self.alone_memo: dict[str, bool] = {}
        self.apart_memo: dict[tuple[str, str], bool] = {}
        self.blank = False  # whether a chunk without words was met
        self.older: dict[str, tuple[bytes, bytes]] = {}
        self.older_words: dict[str, tuple[bytes, bytes]] = {}
        self.word_memo: dict[str, tuple[bytes, bytes]] = {}
        self.memo: dict[str, tuple[bytes, bytes]] = {}

    def _folded(self, token: str) -> str:
        """The token with its word-final mark, if any, on its last symbol."""
        if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix):
            body = token[: -len(self.suffix)]
            return body[:-1] + chr(ord(body[-1]) + FINAL)
        return token

    def apart(self, a: str, b: str) -> bool:
        """Whether BPE of a's and b's symbols ends in a and b: undo merges from the latest, meeting none across the seam."""
        known = self.apart_memo.get((a, b))
        if known is not None:
            return known
        rank, limit, x, y = self.rank, 1 << 60, a, b
        while True:
            joined = self.merge.get((x, y))
            if joined is not None and joined < limit:
                out = False
                break
            i, j = rank.get(x, -1), rank.get(y, -1)
            if i < 0 and j < 0:
                out = True
                break
            if i > j:
                limit, x = i, self.right[x]
            else:
                limit, y = j + 1, self.left[y]
        if len(self.apart_memo) > 3 * MEMO_WORDS:
            self.apart_memo.clear()
        self.apart_memo[a, b] = out
        return out

    def last_token(self, word: str, end: int, states: list[str | None]) -> str:
        """State of the node of word's first `end` symbols; states[k] is that of its first k, or None until it is asked for."""
        tokens, lengths, apart = self.token_of, self.lengths, self.apart_memo
        for n in (lengths.get(word[max(end - 3, 0) : end]) or lengths.get(word[end - 2 : end], (1,))) if end > 1 else (1,):
            if n < end:
                if (token := word[end - n : end]) in tokens:
                    before = states[end - n]
                    if before is None:
                        before = states[end - n] = self.last_token(word, end - n, states)
                    if (known := apart.get((before, token))) or known is None and self.apart(before, token):
                        return token
            elif n == end and (token := word[:end]) in tokens and self.alone(token):
                return token
        raise ValueError(f"no token ends at {word[:end]!r}")

    def alone(self, token: str) -> bool:
        """Whether a token's own symbols encode to it: merged step by step, once for each token."""
        known = self.alone_memo.get(token)
        if known is None:
            parts = list(token)
            while len(parts) > 1:
                best = min((self.merge.get(pair, 1 << 60), k) for k, pair in enumerate(zip(parts, parts[1:])))
                if best[0] == 1 << 60:
                    break
                parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
            known = self.alone_memo[token] = len(parts) == 1
        return known

    def encode_words(self, words: Iterable[str]) -> dict[str, tuple[int, ...]]:
        """Ids of distinct words (in byte symbols, the last one raised), by one depth-first walk of their trie."""
        out, states, before, tokens = {}, [""], "", self.token_of
        for word in sorted(words):
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            states[shared + 1 :] = [None] * (len(word) - shared)
            if len(word) > DEEP:
                for k in range(1, len(word)):
                    states[k] = states[k] or self.last_token(word, k, states)
            ids, at = [], len(word)
            while at:
                token = states[at] = states[at] or self.last_token(word, at, states)
                ids.append(tokens[token])
                at -= len(token)
            out[word], before = tuple(reversed(ids)), word
        return out

    def symbols(self, word: str) -> str:
        s = word if word.isascii() and word.isprintable() else "".join([self.table[b] for b in word.encode("utf-8", "replace")])
        return self.raised(s)

    def raised(self, symbols: str) -> str:
        """A word's symbols with its last one marked as final."""
        return symbols[:-1] + chr(ord(symbols[-1]) + FINAL) if self.suffix else symbols

    def chunks(self, text: str) -> list[str]:
        """White-space free chunks of a text without added tokens, normalised. No token crosses a chunk's end."""
        if text.isascii():
            odd = any(c in text for c in "\x1c\x1d\x1e\x1f")
        else:
            odd = ODD_SPACE.search(text) or self.newer(text) or not unicodedata.is_normalized("NFC", text)
        if odd:
            text = self.normalizer.normalize_str(text)
            return [part[0] for part in regex.finditer(r"\S+", text)] if not ODD_SPACE.search(text) else ["\0" + text]
        return text.lower().split()

    def parts(self, text: str) -> list[str]:
        """Chunks and added tokens of a text."""
        if not any(name in text for name in self.added):
            return self.chunks(text) if text else []
        return [c for p in self.cut(text) if p for c in ([p] if p in self.added else self.chunks(p))]

    def _words_of(self, chunk: str) -> list[str]:
        """The chunk's words as they are written, or in byte symbols behind a mark where the library splits: a whole normalised text
        with odd white space, and marks or letters on which two versions of Unicode may not agree."""
        if chunk[0] == "\0" and ODD_SPACE.search(chunk):
            return ["\0 " + w for w, _ in self.splitter.pre_tokenize_str(chunk[1:])]
        if found := PLAIN(chunk):
            return [x for x in found.groups() if x]
        return self.words(chunk) if chunk.isascii() else ["\0 " + w for w, _ in self.splitter.pre_tokenize_str(chunk)]

    def learn(self, chunks: set[str]) -> None:
        """Puts chunks that the memory lacks into it, what the last generation knew and otherwise by the trie."""
        memo, older, new = self.memo, self.older, {}
        for c in chunks:
            if (kept := older.get(c)) is not None:
                memo[c] = kept
            else:
                new[c] = self._words_of(c)
        if len(self.word_memo) > MEMO_WORDS:
            self.word_memo, self.older_words = {}, self.word_memo
        known, before, unknown = self.word_memo, self.older_words, {}
        for w in {*chain.from_iterable(new.values())}.difference(known):
            if (kept := before.get(w)) is not None:
                known[w] = kept
            else:
                unknown[w] = self.raised(w[2:]) if w[:2] == "\0 " else self.symbols(w)
        coded, decimal, spelled = self.encode_words({*unknown.values()}), self.decimal, self.spelled
        for w, symbols in unknown.items():
            ids = coded[symbols]
            known[w] = b" ".join([decimal[i] for i in ids]), b" ".join([spelled[i] for i in ids])
        for chunk, words in new.items():
            if len(words) == 1:
                memo[chunk] = known[words[0]]
            else:
                self.blank |= not words
                pairs = [known[w] for w in words]
                memo[chunk] = b" ".join([p[0] for p in pairs]), b" ".join([p[1] for p in pairs])

    def decode(self, ids: Iterable[int]) -> str:
        """The file names no decoder, so the tokens' strings are joined by spaces, special ones included."""
        return " ".join([self.names[i] for i in ids])

    def code(self, texts: list[str]) -> list[list[tuple[int, bytes, bytes, tuple[int, ...]]]]:
        """Per text, its coded chunks: count, decimal ids, decoded text, ids."""
        return [[(len(ids := tuple(map(int, a.split()))), a, b, ids) for a, b in pairs] for pairs in self.pairs(texts)]

    def pairs(self, texts: list[str]) -> list[list[tuple[bytes, bytes]]]:
        """Per text, decimal ids and decoded text of its chunks."""
        collects = gc.isenabled()
        gc.disable()  # the memories hold no cycles, and walking them costs a fifth of the time
        try:
            if len(self.memo) > MEMO_CHUNKS:
                self.memo, self.older = {}, self.memo
            memo = self.memo
            memo |= {name: (b"%d" % i, name.encode()) for name, i in self.added.items()}
            split = [self.parts(t) for t in texts]
            found = [[*map(memo.get, chunks)] for chunks in split]
            short = [k for k, pairs in enumerate(found) if None in pairs]
            self.learn({c for k in short for c, pair in zip(split[k], found[k]) if pair is None})
            for k in short:
                found[k] = [pair or memo[c] for c, pair in zip(split[k], found[k])]
            return [[pair for pair in pairs if pair[0]] for pairs in found] if self.blank else found
        finally:
            if collects:
                gc.enable()


@lru_cache(maxsize=2)
def coder(path: str) -> TrieCoder:
    return TrieCoder(path)


def bpe_round_trip(df: DataFrame, path: str, outputs: bool = False) -> DataFrame:
    """Every text encoded and decoded again: n_tokens and digests; with outputs also the ids and the decoded text."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] + [("ids", pa.list_(pa.int32())), ("decoded", pa.string())] * outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = coder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                rows = []
                for doc_id, coded in zip(part.column(0).to_pylist(), tool.pairs(part.column(1).to_pylist())):
                    ids, decoded = b" ".join([x[0] for x in coded]), b" ".join([x[1] for x in coded])
                    row = (doc_id, ids.count(b" ") + 1 if ids else 0, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest())
                    rows.append(row + ((list(map(int, ids.split())), decoded.decode()) if outputs else ()))
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return id_text(df).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * outputs)


def decode_ids(df: DataFrame, path: str) -> DataFrame:
    """doc_id and decoded text of a table with doc_id and ids (null: empty)."""
    schema = pa.schema([("doc_id", pa.int64()), ("decoded", pa.string())])
    return df.select(df.doc_id.cast("long"), df.ids.cast("array<int>")).mapInArrow(row_map(lambda doc_id, ids: [(doc_id, coder(path).decode(ids or ()))], schema), "doc_id long, decoded string")
