"""I-Match fingerprints against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

from odd_inputs import make_docs, no_docs, odd_docs  # noqa: F401

from tradelanes.llm import matching


def corpus(n=300):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    rows = [(i * 7 % 1009, " ".join(rng.choices(words, weights=[1 / (k + 1) for k in range(400)], k=rng.randint(0, 80))), "en", "s") for i in range(n)]
    return rows + [(2000 + i, rows[5][1], "en", "s") for i in range(3)]


def test_next_and_edited_texts(make_docs):
    rows = corpus()
    lexicons = matching.Lexicons(matching.band(make_docs(rows)))
    got = {r.doc_id: r for r in matching.near_report(make_docs(rows), lexicons).collect()}
    order = sorted(rows)
    assert len(got) == len(order)
    for k, (i, text, *_) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        mine, its, next_ = (lexicons.fingerprint(t) for t in (text, new, following))
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (mine, its)
        assert (r.near_edited, r.near_next) == (matching.likeness(mine, its), matching.likeness(mine, next_))
    assert len({got[i].fingerprint for i in (rows[5][0], 2000, 2001, 2002)}) == 1
    assert sum(r.near_edited for r in got.values()) > 2 * sum(r.near_next for r in got.values() if r.near_next < 1)


def test_band_counts_all_documents(make_docs):
    rows = corpus()
    n = Counter(t for _, text, *_ in rows for t in matching.terms(text))
    docs = sum(bool(text) for _, text, *_ in rows)
    for rare, common in ((1 / 500, 1 / 4), (0.02, 0.1)):
        right = {t for t, c in n.items() if c > 1 and rare * docs <= c <= common * docs}
        assert set(matching.band(make_docs(rows), rare=rare, common=common)) == right and right
    # The band is one of idf: the same terms in a corpus of twice the size
    twice = rows + [(5000 + i, *r) for i, *r in rows]
    assert set(matching.band(make_docs(twice), rare=0.02, common=0.1)) == right


def test_fingerprint_is_sorted_terms_of_each_lexicon():
    lexicons = matching.Lexicons(sorted(matching.terms("alpha beta gamma delta epsilon zeta eta theta")))
    assert lexicons.fingerprint("Beta alpha, beta! gamma") == lexicons.fingerprint("gamma alpha beta unknown")
    assert matching.likeness(lexicons.fingerprint(None), lexicons.fingerprint("unknown")) == 0.0
    assert matching.likeness(lexicons.fingerprint(None), lexicons.fingerprint("")) == 1.0
    assert lexicons.fingerprint("") == matching.EMPTY * matching.LEXICONS
    assert matching.likeness(lexicons.fingerprint("alpha"), lexicons.fingerprint("theta")) == 0.0


def test_texts_without_lexicon_terms():
    lexicons = matching.Lexicons(sorted(matching.terms("alpha beta gamma delta")))
    marks = [lexicons.fingerprint(t) for t in ("ein Text", "ganz anders", "Text, ein", "...", "!!")]
    assert matching.EMPTY * matching.LEXICONS not in marks
    assert matching.likeness(marks[0], marks[2]) == 1.0
    assert [matching.likeness(marks[0], m) for m in (marks[1], marks[3], lexicons.fingerprint("alpha beta gamma"))] == [0.0] * 3
    assert matching.likeness(marks[3], marks[4]) == 0.0


def test_odd_inputs(odd_docs, no_docs, make_docs):
    lexicons = matching.Lexicons(matching.band(odd_docs))
    rows = matching.near_report(odd_docs, lexicons).collect()
    assert len(rows) == 12
    by = Counter((r.doc_id, r.n_chars) for r in rows)
    assert by[3, 0] == by[4, 0] == by[None, 0] == 1 and by[1, 76] == 2
    last = next(r for r in rows if r.doc_id == 8)  # the next is the first: a null id, texts by key
    assert last.n_chars == 4 and last.edited_sha256 in {hashlib.sha256(x).hexdigest() for x in (b"On", b"OnA ")}
    empty = matching.Lexicons(matching.band(no_docs))
    assert matching.near_report(no_docs, empty).count() == 0
    one = matching.near_report(make_docs([(9, "abcd", "en", "s")]), empty).collect()
    assert [(r.doc_id, r.edited_sha256, r.near_next) for r in one] == [(9, hashlib.sha256(b"abab").hexdigest(), 1.0)]
