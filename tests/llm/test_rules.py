"""Quality rules against plain statistics, and the forest on planted junk."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
from odd_inputs import make_docs, no_docs, odd_docs, odd_rows  # noqa: F401

from tradelanes.llm import rules

SPACE = " \t\n\x0b\x0c\r"


def plain(text):
    words = [w for w in "".join(" " if c in SPACE else c for c in text or "").split(" ") if w]
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.strip(SPACE)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), len(lines))


def texts(n=600, seed=4):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéilnorstü") for _ in range(rng.randint(1, 9))) for _ in range(800)]
    rows = []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([60, 200, 600, 1500]))]
        if bad := i % 9 == 0:
            words = [w + rng.choice(["***", "%%%", "&&&"]) for w in words]
        if i % 13 == 0:
            words += words[:20] * 2
        lines = [" ".join(words[k:k + 12]) for k in range(0, len(words), 12)]
        rows.append((i, "\n".join(lines + lines[:2] * (i % 7 == 0)), int(not bad)))
    return rows


def test_statistics_of_any_text():
    rng = random.Random(0)
    cases = ["", " ", "a", "a a", "a a a", "a a a a", "a b c a b c", "x\x85y z   é", "a\n\na\n a\na", "#*$%&|<># ##", "\x1c a \x1f"]
    cases += ["".join(rng.choice("ab \n#é\t\r") for _ in range(rng.randint(0, 200))) for _ in range(300)]
    for text in cases:
        assert rules.statistics(text.encode()) == plain(text), text


def test_judge_keeps_good_and_refuses_planted_junk(spark):
    rows = texts()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, q) for i, _, q in rows if i % 3 == 0] + [(None, 1), (7, None), (10**9, 0)], "doc_id long, quality int")
    got = {r.doc_id: r for r in rules.judge(docs, labels).collect()}
    assert len(got) == len(rows)
    for i, text, good in rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_lines) == plain(text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    judged = [(got[i].kept, q) for i, _, q in rows if not got[i].base_failed]
    assert np.mean([k for k, q in judged if q]) >= 0.97 and not any(k for k, q in judged if not q)
    same = {r.doc_id: r for r in rules.judge(docs.repartition(2), labels).collect()}
    assert same == got
    unlabelled = rules.judge(docs, labels.where("quality = 1")).collect()
    assert all(r.kept != r.base_failed for r in unlabelled)


def test_odd_inputs(spark, odd_docs, no_docs):
    """Null and empty texts have no words and fail, null ids and repeated rows stay, an empty table has no rows."""
    labels = spark.createDataFrame([(6, 1), (6, 0), (None, 1)], "doc_id long, quality int")
    got = rules.judge(odd_docs, labels).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(((r.doc_id, r.n_words, r.n_lines, r.n_repeat_words) for r in got), key=key) == sorted(
        ((r[0], plain(r[1])[0], plain(r[1])[5], plain(r[1])[4]) for r in odd_rows()), key=key)
    assert all(r.base_failed and not r.kept for r in got)  # the long one repeats itself
    assert rules.judge(no_docs, labels).count() == 0
    assert rules.judge(odd_docs, labels.limit(0)).count() == len(got)


def test_forest_learns_from_the_lowest_hashes(spark, monkeypatch):
    """The same rows whatever share of the hashes is looked at first, with copies that leave too few."""
    rows = [(i, t) for i, t, _ in texts(300)] + [(1000 + i, texts(1)[0][1]) for i in range(900)]
    stats = rules.rule_statistics(spark.createDataFrame(rows, "doc_id long, text string")).cache()
    taken = []
    monkeypatch.setattr(rules, "Forests", lambda sample, *a: taken.append(sample))
    rules.grow(stats, trees=10, size=10)
    monkeypatch.setattr(rules, "min", lambda *a: 1.0, raising=False)  # all of them at once
    rules.grow(stats, trees=10, size=10)
    assert taken[0].shape == (100, 4) and np.array_equal(*taken)


def plain_path(forest, tree, row):
    node = 0
    while forest.column[tree, node] >= 0:
        node = 2 * node + (1 if row[forest.column[tree, node]] <= forest.value[tree, node] else 2)
    return forest.path[tree, node]


def test_forest_scores_equal_walks_and_rank_outliers():
    rng = np.random.default_rng(2)
    sample = np.concatenate([rng.normal(0, 1, (500, 3)), [[9, 9, 9]]])
    forest = rules.Forest(sample, trees=40, size=128)
    score = forest.score(sample, at_once=64)
    walked = [2 ** -(np.mean([plain_path(forest, t, r) for t in range(40)]) / rules.expected_path(128)) for r in sample]
    assert np.allclose(score, walked) and score.argmax() == 500
    assert score.tolist() == [forest.score(r[None])[0] for r in sample]  # alone or in any batch
    for few in (np.zeros((0, 2)), np.zeros((1, 2)), np.ones((50, 2))):
        assert np.isfinite(rules.Forest(few, trees=3).score(np.ones((2, 2)))).all()


def test_threshold():
    good, bad = np.zeros(rules.BINS + 1), np.zeros(rules.BINS + 1)
    good[100], good[900], bad[500] = 998, 2, 50
    gain, cut = rules.threshold(good, bad, 1000, 50)
    assert round(gain, 3) == 0.998 and 0.101 <= cut <= 0.5
    assert rules.threshold(good, bad, 1000, 50, most_lost=0.001) == (0.0, 2.0)
    assert rules.threshold(good, good, 1000, 1000) == (0.0, 2.0)
