"""Spelling variants against all pairs of words and a plain edit distance."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
from odd_inputs import make_docs, no_docs, odd_docs, odd_rows  # noqa: F401

from tradelanes.llm import spelling


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_vocabulary(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 31 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            n[word] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def plain_variants(n):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    best = {w: min(v, key=lambda x: (-n[x], x)) for w, v in near.items() if v}
    form = {w: b for w, b in best.items() if n[b] >= 10 * n[w]}
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None)
    return out


def found(words):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(words).collect()}


def corpus(docs=400, seed=3):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abeéàlnorstÿß") for _ in range(rng.randint(6, 11))) for _ in range(150)]
    rows = []
    for i in range(docs):
        words = []
        for _ in range(60):
            w = stems[min(int(rng.expovariate(0.05)), 149)]
            if rng.random() < 0.08:
                at, kind = rng.randrange(len(w)), rng.randrange(3)
                w = w[:at] + ("" if kind == 0 else rng.choice("abeé")) + w[at + (kind != 2):]
            words.append(w.upper() if rng.random() < 0.05 else w)
        rows.append((i if i else None, " ".join(words) + "-×ABCdefÀgh, ABCdefÀgh."))
    return rows


def test_variants_equal_all_pairs(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    words = spelling.vocabulary(docs, drop_one_in=31)
    want = plain_vocabulary(rows)
    assert {r.word: r.n for r in words.collect()} == want and len(want) > 500
    assert found(words) == plain_variants(want)


def test_hot_block_and_long_words(spark):
    """Anagram-like words of one block over many chunks, words whose counts need double precision, ways over several forms."""
    rng = random.Random(1)
    hot = {"".join(rng.sample("abcdefgh", 8)): rng.randint(2, 9) for _ in range(1500)}
    hot |= {w[:k] + "i" + w[k:]: 2 for w in list(hot)[:100] for k in (0, 4, 8)}
    long = "ab" * 5000
    hot |= {long: 3, long + "a": 30, long[:-1] + "c": 400, "x" * 5000: 2}
    hot |= {"zwischen": 5000, "zwschen": 400, "zwschn": 30, "zwsch": 2, "zwzchen": 400}
    words = spark.createDataFrame(list(hot.items()), "word string, n long")
    assert found(words) == plain_variants(hot)


def test_odd_inputs(spark, odd_docs, no_docs):
    """Null ids read as '', null texts have no words, repeated rows count each; no texts and no words give no rows."""
    want = plain_vocabulary([(r[0], r[1]) for r in odd_rows()])
    assert found(spelling.vocabulary(odd_docs, drop_one_in=31)) == plain_variants(want)
    none = spelling.vocabulary(no_docs, drop_one_in=31)
    assert none.count() == 0 and found(none) == {}
    assert {r.word: r.n for r in spelling.vocabulary(odd_docs, least_chars=5, least=5).collect()}["quick"] == 3003


def test_one_edit_of_arrays():
    rng = np.random.default_rng(0)
    for length, more in ((1, 0), (4, 0), (4, 1), (7, 1)):
        a, b = rng.integers(0, 3, (400, length)), rng.integers(0, 3, (400, length + more))
        text = lambda r: "".join(map(str, r))
        assert spelling.one_edit(a, b).tolist() == [one_edit(text(x), text(y)) for x, y in zip(a, b)]


def test_blocks_meet_once():
    """Of two blocks that can hold near words exactly one meets the other."""
    a, b = (2, 0, 1, 0, 3, 1), (1, 1, 1, 0, 3, 1)
    assert sum(spelling.block_key(7, y) in spelling.meets(7, x) for x, y in ((a, b), (b, a))) == 1
    assert spelling.block_key(8, (2, 0, 1, 0, 3, 2)) in spelling.meets(7, a) and spelling.meets(7, a)[0] == spelling.block_key(7, a)
