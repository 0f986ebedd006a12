"""Byte-level BPE by speculation and verification.

A greedy longest match proposes tokens for every distinct word.  A row of tokens is what
merging would give exactly when each token is what merging gives for its own bytes and each
neighbouring pair is what merging gives for the bytes of both; so one vectorised lookup of all
neighbouring pairs decides which proposals stand.  Pairs not met before are merged once and
remembered.  Only words with a failing token or pair are merged as a whole.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

# Ranges whose letters and numbers are newer than the character tables of the
# tokenizers library, which takes them for other symbols.
_NEWER = (
    "0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF "
    "10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 "
    "16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 "
    "1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 "
    "1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
# Fixed value: how the byte-level pre-tokenizer splits a text into words ({L} letters, {N} numbers).
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?[^\s{l}{n}]+|\s+(?!\S)|\s+"


_SHORT = 64  # bytes up to which a plain scan for the lowest rank is the faster way


def _newer_class() -> str:
    return "".join("-".join(rf"\U{int(x, 16):08x}" for x in part.split("-")) for part in _NEWER.split())


NEWER = regex.compile(f"[{_newer_class()}]")
WORDS = regex.compile(_WORDS.format(L=r"\p{L}", N=r"\p{N}", l=r"\p{L}", n=r"\p{N}"))
WORDS_OLD = regex.compile(
    "(?V1)" + _WORDS.replace(r"[^\s{l}{n}]", r"[^\s{L}{N}]").replace("{L}", rf"[\p{{L}}--[{_newer_class()}]]")
    .replace("{N}", rf"[\p{{N}}--[{_newer_class()}]]"))


def split_words(text: str) -> list[str]:
    if not text.isascii() and NEWER.search(text):
        return WORDS_OLD.findall(text)
    return WORDS.findall(text)


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary: bytes that print stand for
    themselves, the others take the code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> dict:
    """Ids, merges in order and special tokens of a byte-level tokenizer file, as bytes.
    Truncation and padding settings of the file are not used."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    of = byte_symbols()
    plain = lambda token: bytes(of[c] for c in token)
    pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
    return {
        "ids": {plain(t): i for t, i in spec["model"]["vocab"].items() if all(c in of for c in t)},
        "merges": [tuple(map(plain, p)) for p in pairs],
        "special": {t["content"]: t["id"] for t in spec.get("added_tokens", [])},
    }


class Codec:
    """Encodes and decodes words; one per Python worker, so what was learnt serves later batches."""

    def __init__(self, vocabulary: dict, remember: int = 500_000):
        self.ids: dict[bytes, int] = vocabulary["ids"]
        self.special: dict[str, int] = vocabulary["special"]
        self.bytes = {i: t for t, i in self.ids.items()} | {i: t.encode() for t, i in self.special.items()}
        # A merge of ids: (left, right) -> (rank, merged)
        self.merges = {(self.ids[a], self.ids[b]): k for k, (a, b) in enumerate(vocabulary["merges"])}
        self.merged = [self.ids[a + b] for a, b in vocabulary["merges"]]
        self.longest = max(map(len, self.ids))
        self.single = [self.ids.get(bytes([b])) for b in range(256)]
        self.width = max(self.bytes) + 1
        self.sound: dict[int, bool] = {}  # whether merging gives a token for its own bytes
        self.pairs: dict[int, bool] = {}  # whether it gives a pair of tokens for the bytes of both
        self.remember, self.words = remember, {}
        self.exact = 0  # words merged as a whole
        names = sorted(self.special, key=lambda s: (-len(s), s))
        self.specials = regex.compile("|".join(map(regex.escape, names))) if names else None

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: the pair of the lowest rank first, leftmost first among equals."""
        at, get, none = [self.single[b] for b in word], self.merges.get, len(self.merged)
        if len(at) > _SHORT:
            return self._merge_long(at)
        ranks = [get(p, none) for p in zip(at, at[1:])]
        while ranks and (rank := min(ranks)) < none:
            i = ranks.index(rank)
            at[i: i + 2] = [self.merged[rank]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get((at[i], at[i + 1]), none)
            if i:
                ranks[i - 1] = get((at[i - 1], at[i]), none)
        return at

    def _merge_long(self, at: list[int]) -> list[int]:
        """The same with a heap and linked neighbours: n log n for words of any length."""
        before, after = list(range(-1, len(at) - 1)), [*range(1, len(at)), -1]
        heap = [(self.merges[p], i, *p) for i, p in enumerate(zip(at, at[1:])) if p in self.merges]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if at[i] != a or j < 0 or at[j] != b:
                continue  # one side has been merged meanwhile
            at[i], at[j], after[i] = self.merged[rank], None, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (r := self.merges.get((at[x], at[y]))) is not None:
                    heapq.heappush(heap, (r, x, at[x], at[y]))
        return [t for t in at if t is not None]

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match from the left."""
        out, at, ids = [], 0, self.ids
        while at < len(word):
            for end in range(min(len(word), at + self.longest), at, -1):
                if (i := ids.get(word[at:end])) is not None:
                    out.append(i)
                    at = end
                    break
        return out

    def _stands(self, keys: np.ndarray, known: dict[int, bool], tokens) -> np.ndarray:
        """Whether merging gives just the tokens of each key for their bytes; asked once for each key."""
        distinct, where = np.unique(keys, return_inverse=True)
        for key in distinct.tolist():
            if key not in known:
                row = tokens(key)
                known[key] = self.merge(b"".join(self.bytes[t] for t in row)) == row
        return np.fromiter((known[k] for k in distinct.tolist()), bool, len(distinct))[where]

    def learn(self, words: set[str]) -> None:
        """Ids of all these words, as little-endian unsigned 32-bit integers."""
        if len(self.words) > self.remember:
            self.words = {}
        if len(self.pairs) > 4 * self.remember:
            self.pairs = {}
        new = [w for w in words if w not in self.words]
        if not new:
            return
        raw = [w.encode() for w in new]
        proposed = [[i] if (i := self.ids.get(w)) is not None else self.propose(w) for w in raw]
        flat = np.fromiter((t for p in proposed for t in p), np.int64)
        owner = np.repeat(np.arange(len(new)), [len(p) for p in proposed])
        bad = np.zeros(len(new), bool)
        bad[owner[~self._stands(flat, self.sound, lambda k: [k])]] = True
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        pairs = flat[inside] * self.width + flat[inside + 1]
        bad[owner[inside[~self._stands(pairs, self.pairs, lambda k: list(divmod(k, self.width)))]]] = True
        for k in np.flatnonzero(bad).tolist():
            proposed[k] = self.merge(raw[k])
        self.exact += int(bad.sum())
        for w, p in zip(new, proposed):
            self.words[w] = np.array(p, "<u4").tobytes()

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; special tokens that occur in a text stand for themselves."""
        pieces = []
        for text in texts:
            parts, at = [], 0
            if self.specials is not None:
                for m in self.specials.finditer(text):
                    parts += [split_words(text[at: m.start()]), self.special[m.group()]]
                    at = m.end()
            pieces.append([*parts, split_words(text[at:] if at else text)])
        self.learn({w for parts in pieces for p in parts if isinstance(p, list) for w in p})
        known = self.words
        one = lambda p: np.uint32(p).astype("<u4").tobytes() if isinstance(p, int) else b"".join([known[w] for w in p])
        return [b"".join(map(one, parts)) for parts in pieces]

    def decode(self, ids: bytes) -> str:
        of = self.bytes
        return b"".join([of[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


_LEARNT: dict[str, Codec] = {}  # of this Python worker, by vocabulary: later tasks go on with what is known


def _codec(name: str, vocabulary) -> Codec:
    if name not in _LEARNT:
        _LEARNT.clear()
        _LEARNT[name] = Codec(vocabulary())
    return _LEARNT[name]


def _chunks(texts: list[str], size: int = 1 << 21) -> Iterator[list[str]]:
    """Consecutive texts, about ``size`` characters at a time."""
    held, n = [], 0
    for t in texts:
        held.append(t)
        n += len(t)
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def encode(spark: SparkSession, docs: DataFrame, vocabulary_path: str, digests: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text (null as empty).

    Returns doc_id and n_tokens with ids (array<int>) and decoded, or with ``digests`` the SHA-256
    of each.  One row for each input row, repeats included; null ids stay null; an empty text has
    no tokens; texts of any length are encoded whole; other columns are not read.
    The vocabulary is read once by the driver and broadcast (a file of fixed size).
    """
    vocabulary = read_vocabulary(vocabulary_path)
    name = hashlib.sha256(repr(vocabulary).encode()).hexdigest()
    shared = spark.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(name, lambda: shared.value)
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for batch in batches:
            at = 0
            for texts in _chunks([t or "" for t in batch.column(1).to_pylist()]):
                ids = codec.encode_batch(texts)
                back = map(codec.decode, ids)
                if digests:
                    out = [pa.array(map(sha, ids), pa.string()), pa.array((sha(t.encode()) for t in back), pa.string())]
                else:
                    out = [pa.array([np.frombuffer(i, "<u4").astype(np.int32) for i in ids], pa.list_(pa.int32())),
                           pa.array(back, pa.string())]
                counts = pa.array([len(i) // 4 for i in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), counts, *out], names)
                at += len(texts)

    names = ["doc_id", "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded"))]
    rest = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, f"doc_id long, n_tokens long, {rest}")
