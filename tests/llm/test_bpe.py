"""BPE against the tokenizers library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from odd_inputs import no_docs, odd_docs  # noqa: F401

from tradelanes.llm import bpe
from tradelanes.llm.queries import vocabulary_path

PIECES = [" ", "  ", "\n", "\t", "\x85", "\xa0", " ", "a", "b", "th", "ing", "é", "ß", "1", "٣", "²", "Ⅷ", "!", "?", "'s", "'ll", "'", "<|endoftext|>",
          "<|endof", "中", "文", "😀", "\x00", "\x1c", "՘", "\U0002b73a", "ſ", "İ", "́", "AKIA", "​", "﻿", "qz", "\r\n"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_vocabulary(vocabulary_path()))


def texts(n=4000):
    rng = random.Random(5)
    out = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    out += ["".join(chr(rng.choice([rng.randint(1, 0x2FF), rng.randint(1, 0xD7FF), rng.randint(0xE000, 0x10FFFF)])) for _ in range(20)) for _ in range(n)]
    return out + ["", "a" * 20_000, " " * 5000, "".join(rng.choice("abcdefgh") for _ in range(5000))]


def test_ids_and_texts_are_the_librarys(codec, library):
    for text, ids, right in zip(texts(), codec.encode_batch(texts()), library.encode_batch(texts(), add_special_tokens=False)):
        assert np.frombuffer(ids, "<u4").tolist() == right.ids, text
        assert codec.decode(ids) == library.decode(right.ids, skip_special_tokens=False)


def test_letters_newer_than_the_librarys_tables(codec, library):
    """All code points, each beside a letter, a number and a mark."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 50_000):
        text = "".join(f"a{c}1{c}!{c}\n" for c in points[at: at + 50_000: 7])
        assert [bpe.split_words(text)] == [[text[s:e] for _, (s, e) in library.pre_tokenizer.pre_tokenize_str(text)]]


def test_only_failing_words_are_merged(codec):
    fresh = bpe.Codec(bpe.read_vocabulary(vocabulary_path()))
    fresh.encode_batch(["the of and in to is that for it as with was"])
    assert fresh.exact == 0


def test_both_ways_of_merging_agree(codec):
    rng = random.Random(2)
    for _ in range(300):
        word = bytes(rng.choice(b"abcdethingos ") for _ in range(rng.randint(1, bpe._SHORT)))
        assert codec.merge(word) == codec._merge_long([codec.single[b] for b in word])


def test_forgetting_changes_nothing(library):
    small = bpe.Codec(bpe.read_vocabulary(vocabulary_path()), remember=10)
    for at in range(0, 300, 7):
        part = texts(150)[at: at + 7]
        assert [np.frombuffer(i, "<u4").tolist() for i in small.encode_batch(part)] == [e.ids for e in library.encode_batch(part, add_special_tokens=False)]


def test_odd_inputs(spark, odd_docs, no_docs, library):
    path = vocabulary_path()
    rows = bpe.encode(spark, odd_docs, path).collect()
    assert len(rows) == 12
    got = sorted((r.doc_id is None, r.doc_id or 0, r.decoded, r.n_tokens, tuple(r.ids)) for r in rows)
    right = []
    for r in odd_docs.select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        right.append((r.doc_id is None, r.doc_id or 0, r.text or "", len(ids), tuple(ids)))
    assert got == sorted(right)
    digest = bpe.encode(spark, odd_docs, path, digests=True).where("doc_id = 8").first()
    ids = np.array(library.encode("One.").ids, "<u4")
    assert (digest.ids_sha256, digest.decoded_sha256) == (hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(b"One.").hexdigest())
    assert bpe.encode(spark, no_docs, path).count() == 0
