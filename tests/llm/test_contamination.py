"""Benchmark decontamination on planted cases."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd_inputs import make_docs, no_docs, odd_docs  # noqa: F401

from tradelanes.llm import contamination

ITEMS = [
    (1, "A train leaves the old station with 120 passengers and after 3 hours it has carried Anna 240 km through the green valley."),
    (2, "If Peter buys 5 apples and gives 5 apples to Maria, how many apples are left for him?"),
    (3, "Short item only here."),
    (4, "1 2 3 4 5 6"),
    (5, None),
    (6, ""),
    (7, "Tiny."),
    (1, "A second text under the same item id, about rivers that run to the sea."),
]
FILL = "Some words of the page that have nothing to do with any question in the set."
CASES = {
    10: (f"{FILL} {ITEMS[0][1]} {FILL}", {1}),  # verbatim
    11: (f"{FILL} a train leaves the old station with 75 passengers and after 9 hours it has carried Bob 810 miles through the green valley {FILL}", {1}),  # other values
    12: (f"{FILL} If Hans buys 7 apples and gives 7 apples to Klara, how many apples are left for him? {FILL}", {2}),  # 5 becomes 7 all through
    13: (f"{FILL} If Hans buys 7 apples and gives 2 apples to Klara, how many apples are left for him? {FILL}", set()),  # 5 becomes 7 and 2
    14: (f"{FILL} A train leaves the old station with 120 passengers and then nothing more is told of it. {FILL}", set()),  # too little of it
    15: (f"{FILL} short item, only here {FILL}", {3}),
    16: ("1 2 3 4 5 6 7 8 9", {4}),  # no plain words, but the same ones
    17: (FILL, set()),
    18: ("Tiny. " + FILL, set()),
    19: ("A train leaves the *old* station, with 120 passengers and after 3 hours it slowly has carried Anna 240 km through the green valley.", set()),  # a word more costs 5 of 19 windows
    22: ("A train leaves the *old* station, with 120 passengers and after 3 hours it has carried Anna 240 km through the big green valley.", {1}),  # near the end 3
    20: (" ".join([ITEMS[0][1]] * 3), {1}),
    21: (f"{FILL} {ITEMS[7][1].lower()}", {1}),
}


@pytest.fixture
def items(spark):
    return spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, key string")


def test_planted_cases(make_docs, items):
    got = {}
    for r in contamination.leaks(make_docs([(i, t, "en", "s") for i, (t, _) in CASES.items()]), items).collect():
        got.setdefault(r.doc_id, set()).add(r.item_id)
    assert got == {i: right for i, (_, right) in CASES.items() if right}


def pairs(make_docs, spark, item, texts):
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    return {r.doc_id: r.covered for r in contamination.leaks(make_docs([(i, t, "en", "s") for i, t in enumerate(texts)]), items).collect()}


def test_words_put_into_a_long_item(make_docs, spark):
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(59)]
    item = " ".join(words)
    inside = lambda n: " ".join(words[:30] + ["more"] * n + words[30:])
    apart = " ".join(words[:30] + ["more"] * 200 + words[30:])
    assert pairs(make_docs, spark, item, [f"{FILL} {inside(6)} {FILL}", inside(30), apart]) == {0: 51 / 55, 1: 51 / 55}


def test_every_place_is_judged(make_docs, spark):
    item = ITEMS[1][1]
    other = CASES[13][0]
    assert pairs(make_docs, spark, item, [f"{other} {item} {other}", f"{other} {FILL * 5} {item}", f"{other} {other}", f"{item} {other}"]).keys() == {0, 1, 3}


def test_verbatim_copies_without_a_template(make_docs, spark):
    for item in ("12 kg 340 cm 7 miles 99 percent 8", "Ask Anna Maria Peter Hans Klara Otto", "Paris 1789"):
        alone = len(item.split()) < 3
        texts = [item.lower(), f"{FILL} {item} {FILL}", f"{FILL} {item.replace(' 7 ', ' 5 ').replace('Peter', 'Bob').replace('17', '18')}"]
        assert pairs(make_docs, spark, item, texts).keys() == ({0} if alone else {0, 1}), item


def test_capital_after_a_heading(make_docs, spark):
    item = "The quick fox jumps over 3 fences"
    texts = [f"Heading\n{item}", f"as they say, {item}", "Heading\nThe quick fox jumps over 5 fences", "and The quick fox jumps over 5 fences"]
    assert pairs(make_docs, spark, item, texts).keys() == {0, 1, 2, 3}


def test_items_of_one_template_are_one_class(make_docs, spark):
    ask = "If a farmer sells {} brown hens and buys {} white geese, how many birds are on the farm at night?".format
    items = [(i, ask(i + 2, i + 50)) for i in range(40)] + [(50, ask(7, 7)), (None, ask(900, 901))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [f"{FILL} {ask(1000 + i, 2000 + i)} {FILL}" for i in range(30)] + [f"{FILL} {ask(5, 5)} {FILL}", FILL, f"{FILL} {ask(900, 901)}"]
    found = contamination.leaks(make_docs([(i, t, "en", "s") for i, t in enumerate(docs)]), bench)
    rows = sorted((r.doc_id, r.item_id, r.n_items) for r in found.collect())
    # Two equal numbers can be put in for two different ones, but two different ones not for two equal ones.
    assert rows == sorted([(i, 0, 41) for i in [*range(31), 32]] + [(30, 50, 1)])
    by_class = contamination.members(contamination.item_windows(bench)).where("not raw").groupBy("class").count().collect()
    assert sorted(r["count"] for r in by_class) == [1, 41]


def test_items_without_an_id_count(make_docs, spark):
    bench = spark.createDataFrame([(None, ITEMS[1][1])], "item_id long, text string")
    docs = make_docs([(1, CASES[12][0], "en", "s"), (2, FILL, "en", "s")])
    assert [(r.doc_id, r.item_id) for r in contamination.leaks(docs, bench).collect()] == [(1, None)]
    assert [r.doc_id for r in contamination.drop_leaks(docs, bench).collect()] == [2]


def test_filter_holds_every_hash_or_is_left_out(spark):
    hashes = spark.range(5000).select(F.xxhash64("id").alias("h"))
    every = np.array([r.h for r in hashes.collect()]).view(np.uint64)
    made = contamination.window_filter(hashes)
    others = np.random.default_rng(1).integers(0, 1 << 63, 20000).astype(np.uint64) * np.uint64(2)
    assert made.has(every).all() and made.bits == 19 and made.has(others).mean() < 0.02
    tight = contamination.window_filter(hashes, most=16)
    assert tight.has(every).all() and tight.bits == 16 and contamination.window_filter(hashes, most=15) is None


def test_same_rows_without_the_filter(make_docs, items, monkeypatch):
    docs = make_docs([(i, t, "en", "s") for i, (t, _) in CASES.items()])
    rows = lambda: sorted(map(tuple, contamination.leaks(docs, items).collect()))
    with_filter = rows()
    monkeypatch.setattr(contamination, "window_filter", lambda *_: None)
    assert rows() == with_filter


def plain_leaks(texts, items, least=0.8):
    """Pairs by brute force: every item at every place of every text, template and raw windows, no filter, anchors or classes."""
    def parts(text):
        words = contamination.Words()
        owner, codes, slot, ids, raw = contamination.templates([text], words)
        return codes.tolist(), [str(s) for s in slot], [words.bare[i] for i in ids], raw.tolist()

    def tell(codes, at, size):
        return tuple(codes[at: at + size])

    found = set()
    for item_id, item in items:
        ic, islot, iw, iraw = parts(item)
        size = min(len(ic), 5)
        for raw in (False, True):
            ours = [(q, tell(iraw if raw else ic, q, size)) for q in range(len(ic) - size + 1)]
            if not raw:
                ours = [(q, w) for q, w in ours if size >= 3 and islot[q: q + size].count("") >= 3]
            if not ours:
                continue
            for doc_id, text in texts:
                dc, dslot, dw, draw = parts(text)
                if size < 3 and len(dc) != size:
                    continue
                places = {}
                for p in range(len(dc) - size + 1):
                    window = tell(draw if raw else dc, p, size)
                    forms = [(window, 0)]
                    if not raw and dslot[p] == "p":
                        forms.append(((draw[p], *window[1:]), 1))
                    for form, skip in forms:
                        if raw or dslot[p: p + size].count("") + skip >= 3:
                            places.setdefault(form, []).append((p, skip))
                for start in {p for at in places.values() for p, _ in at}:
                    held = [(q, [(p, s) for p, s in places.get(w, []) if start <= p < start + 2 * len(ic)]) for q, w in ours]
                    held = [(q, at) for q, at in held if at]
                    if len(held) < least * len(ours):
                        continue
                    values, before = {}, None
                    for q, at in held:
                        p, skip = at[0] if before is None else min(at, key=lambda x: abs(x[0] - q - before))
                        before = p - q
                        theirs = [(dslot[i], dw[i]) for i in range(p + skip, p + size) if dslot[i]]
                        mine = [(islot[i], iw[i]) for i in range(q, q + size) if islot[i]]
                        if not raw:
                            for m, t in zip(mine, theirs):
                                values.setdefault(m, set()).add(t)
                    if not values or sum(len(v) == 1 for v in values.values()) >= least * len(values):
                        found.add((doc_id, item_id))
    return found


def test_against_all_places_of_all_items(make_docs, spark):
    rng = np.random.default_rng(5)
    words = "the farmer sells brown hens and buys white geese for 3 5 7 kg km Anna Bob Klara Street. miles at night".split()
    items = [(i, " ".join(rng.choice(words, rng.integers(3, 22)))) for i in range(30)]
    texts = []
    for i in range(120):
        item = items[rng.integers(30)][1].split()
        kind = rng.integers(4)
        if kind == 1:
            item = [{"3": "5", "5": "9", "Anna": "Otto"}.get(w, w) for w in item]
        elif kind == 2 and len(item) > 4:
            item[rng.integers(len(item))] = str(rng.choice(words))
        elif kind == 3:
            item = item[: len(item) // 2] + ["more"] * rng.integers(1, 4) + item[len(item) // 2:]
        texts.append((i, " ".join([*rng.choice(words, 4), *item, *rng.choice(words, 4)])))
    classes = contamination.members(contamination.item_windows(bench := spark.createDataFrame(items, "item_id long, text string")))
    assert classes.where("not raw").groupBy("class").count().where("count > 1").count() == 0  # so a row is one item
    got = {(r.doc_id, r.item_id) for r in contamination.leaks(make_docs([(i, t, "en", "s") for i, t in texts]), bench).collect()}
    assert got == plain_leaks(texts, items) and len(got) > 60


def test_odd_inputs(odd_docs, no_docs, items, spark):
    quick = spark.createDataFrame([(9, "the quick brown fox jumps over the lazy dog today")], "item_id long, text string")
    found = [(r.doc_id, r.item_id) for r in contamination.leaks(odd_docs, quick).collect()]
    assert sorted(found) == [(1, 9), (2, 9), (6, 9)]  # in 6, eight of nine words
    kept = contamination.drop_leaks(odd_docs, quick)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.select("doc_id").collect()) == [(False, i) for i in (1, 3, 4, 5, 7, 8)] + [(True, 0)] * 2
    none = items.where("item_id > 100")
    assert contamination.drop_leaks(odd_docs, none).count() == 12 and contamination.leaks(no_docs, items).count() == 0
