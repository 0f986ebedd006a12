"""SimHash near-dedup against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from odd_inputs import make_docs, no_docs, odd_docs  # noqa: F401

from tradelanes.llm import simhash
from tradelanes.llm.common import components

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def plain_fingerprint(text, k=3):
    words = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[i: i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64(s.encode(), seed=42).intdigest()
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles)) if shingles else 0


def plain_roots(codes, most):
    """Smallest index reachable for each code over pairs of at most ``most`` differing bits."""
    up = list(range(len(codes)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(codes):
        for j in range(i):
            if (a ^ codes[j]).bit_count() <= most:
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(codes))]


@pytest.mark.parametrize("text", [None, "", "  \t", "One", "One two", "A B c", "é È ß\x85x y\xa0z w", "a b c " * 500])
def test_fingerprint_is_the_contracts(text):
    assert simhash.fingerprint(text) % 2**64 == plain_fingerprint(text)


def test_blocks_keep_every_pair():
    """Codes that differ in at most k bits agree on one of the k + 1 blocks of the free bits, or the node is not split."""
    for free in range(6):
        mask = (1 << 64) - (1 << free)
        kids = simhash._blocks(mask, 3)
        for a in range(1 << free):
            for bits in ((0, 0), *((i, j) for i in range(free) for j in range(i + 1))):
                b = a ^ (1 << bits[0] | 1 << bits[1] if free else 0)
                assert not kids or any(a & k & ~mask == b & k & ~mask for k in kids)
        assert bool(kids) == (free >= 3)


def clustered(rng, groups, size, flips):
    out = set()
    for _ in range(groups):
        code = rng.getrandbits(64)
        for _ in range(size):
            out.add(code)
            for b in rng.sample(range(64), rng.randint(0, flips)):
                code ^= 1 << b
    return sorted(out)


@pytest.mark.parametrize("most", [0, 1, 2, 3])
def test_tree_search_finds_all_pairs(most):
    rng = random.Random(most)
    codes = np.array(sorted(clustered(rng, 20, 20, 3), key=lambda c: c ^ c >> 1), np.uint64)
    q, c = simhash.GrayTree(codes, fanout=4).search(codes, most)
    near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= most
    assert set(zip(q.tolist(), c.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(near))))
    assert len(q) == near.sum()


@pytest.mark.parametrize("most,node_size", [(2, 4096), (2, 64)])
def test_links_connect_as_all_pairs_do(spark, most, node_size):
    """Small nodes force the index to be split below its first level."""
    rng = random.Random(node_size)
    varying = rng.sample(range(64), 13)
    dense = {(0xABCDEF << 20) ^ sum(1 << b for b in varying if rng.random() < 0.5) for _ in range(1500)}
    codes = sorted(set(clustered(rng, 20, 10, 3)) | dense)
    signed = [c - 2**64 if c >> 63 else c for c in codes]
    links = simhash.close_links(spark.createDataFrame([(c,) for c in signed], "fp long"), "fp", most, node_size)
    found = {r.node: r.root for r in components(links).collect()}
    expect, roots = {}, plain_roots(codes, most)
    for i, r in enumerate(roots):
        expect.setdefault(r, []).append(signed[i])
    for members in expect.values():
        got = {found.get(m, m) for m in members}
        assert got == ({min(members)} if len(members) > 1 else {members[0]})


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(30)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5), (None, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(31)}, **{i: 1000 for i in range(1000, 1100)}}


def test_odd_inputs(odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == 12
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, set()).add((r.fingerprint, r.component_id))
    assert len(by_id[1]) == 2 and {c for _, c in by_id[1]} == {1}
    assert {c for _, c in by_id[2]} == {1}
    # Null, empty and blank texts share fingerprint zero, with the null row among them
    assert by_id[3] == by_id[4] == by_id[5] == {("0" * 16, 3)} and by_id[None] >= {("0" * 16, 3)}
    assert simhash.near_duplicates(no_docs).count() == 0


def test_keep_one_keeps_rows_whole(odd_docs, no_docs):
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.select("doc_id").collect())
    assert ids == [(False, 1), (False, 1), (False, 3), (False, 6), (False, 7), (False, 8), (True, 0)]
    assert simhash.keep_one(no_docs).count() == 0


def test_many_copies_leave_one(make_docs):
    text = "some words that come again and again in copies"
    docs = make_docs([(i, text, "en", "s") for i in range(400)] + [(1000 + i, f"{text} {i} other words {i * 7}", "en", "s") for i in range(30)])
    kept = [r.doc_id for r in simhash.keep_one(docs).collect()]
    codes = {r: plain_fingerprint(t) for r, t in [(0, text)] + [(1000 + i, f"{text} {i} other words {i * 7}") for i in range(30)]}
    ids = sorted(codes)
    assert sorted(kept) == sorted({ids[r] for r in plain_roots([codes[i] for i in ids], 2)})
