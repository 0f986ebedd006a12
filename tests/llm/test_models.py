"""Language, toxicity and quality: held-out accuracy, and what they do with awkward input."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from conftest import SF_SMALL

from odd_inputs import no_docs, odd_docs  # noqa: F401

from tradelanes.llm import language, quality, toxicity
from tradelanes.llm.queries import op8_language

SF = SF_SMALL.replace("sf0.001", "sf0.01")


def test_language_of_held_out_documents(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op8_language(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id] for r in held) >= 0.98 * len(held)


@pytest.fixture(scope="module")
def small_language(spark):
    rows = [("en", "the house and the garden were strong and bright"), ("de", "das haus und der garten waren stark und schön"), (None, "zzz zzz"), ("en", None)]
    return language.train(spark.createDataFrame(rows * 5, "lang string, text string"))


def test_words_first_then_shorter_ngrams(small_language):
    m = small_language
    assert m.languages == ["de", "en"]
    assert m.known(0, "garten") is not None and m.known(0, "gartens") is None and m.known(4, "zzzz") is None
    assert np.array_equal(m.word("garten"), m.known(0, "garten"))
    assert m.predict("gartenhaus")[0] == "de" and m.predict("brightness")[0] == "en"  # words never seen
    assert m.predict("THE Garden")[0] == "en"
    for text in ("", "123 !? ²", "\n"):
        assert m.predict(text) == ("und", 0.0)
    assert m.predict("中文")[0] in m.languages  # letters never seen: all languages tie, the first stands


def test_language_of_odd_inputs(odd_docs, no_docs, small_language):
    rows = language.predict(odd_docs, small_language).collect()
    assert len(rows) == 12 and sorted(r.doc_id for r in rows if r.lang_pred == "und" and r.doc_id) == [3, 4, 5]
    empty = language.train(no_docs.select("lang", "text"))
    assert {r.lang_pred for r in language.predict(odd_docs, empty).collect()} == {"und"}
    assert language.predict(no_docs, empty).count() == 0


def plain_language(rows, text, entries):
    """Language and score from the definitions, all counts in one place."""
    langs = sorted({lang for lang, _ in rows})
    count = {0: {x: Counter() for x in langs}, **{n: {x: Counter() for x in langs} for n in language.GRAMS}}
    for lang, t in rows:
        for w in language.words(t):
            count[0][lang][w] += 1
            for n in language.GRAMS:
                count[n][lang].update(language.grams(w, n))
    held = {n: {e for x in langs for e, c in of[x].items() if c * entries >= of[x].total()} for n, of in count.items()}
    whole = {n: {x: of[x].total() + 0.5 * (len(held[n]) + 1) for x in langs} for n, of in count.items()}
    log = lambda n, e, x: math.log((count[n][x][e] + 0.5) / whole[n][x])

    def back(word, step, x):
        n = language.GRAMS[step]
        last = step + 1 == len(language.GRAMS)
        further = lambda part: math.log(0.4) + (math.log(0.5 / whole[n][x]) if last else back(part, step + 1, x))
        parts = language.grams(word, n)
        if not parts:
            return further(word)
        return sum(log(n, p, x) if p in held[n] else further(p.strip("^$") or p) for p in parts) / len(parts)

    total, found = dict.fromkeys(langs, 0.0), language.words(text)
    for w in found:
        known = w in held[0] or sum(count[0][x][w] for x in langs) > 1
        each = {x: log(0, w, x) if known else back(w, 0, x) for x in langs}
        for x in langs:
            total[x] += (each[x] - sum(each.values()) / len(langs)) / max(1, len(found) / 10)
    best = max(langs, key=lambda x: (total[x], [-ord(c) for c in x]))
    return best, 1 / sum(math.exp(total[x] - total[best]) for x in langs)


def test_language_equals_a_plain_scorer(spark):
    """Words of the held tables, of the stored one and of neither, in texts of one word and of many."""
    rng = random.Random(9)
    lexicon = {x: ["".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(300)] for x, letters in (("aa", "abcdeé"), ("bb", "bcdefg"), ("cc", "cdefgh"))}
    draw = lambda x, k: " ".join(lexicon[x][min(int(rng.expovariate(0.02)), 299)] for _ in range(k))
    rows = [(x, draw(x, 40)) for x in lexicon for _ in range(25)]
    model = language.train(spark.createDataFrame(rows, "lang string, text string"), entries=60)
    assert len(model.row[0]) < 180 < model.rare.count()
    texts = [draw(rng.choice("abc") * 2, k) for k in [1, 2, 5, 30, 200] * 6] + ["".join(rng.choices("abcdefgh", k=9)) + " zzz" for _ in range(10)]
    texts += [lexicon["bb"][299], "éa"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), model).collect()}
    for i, text in enumerate(texts):
        best, score = plain_language(rows, text, 60)
        assert got[i][0] == best and abs(got[i][1] - score) < 1e-4, text


def test_language_learnt_from_one_language(spark, odd_docs):
    model = language.train(spark.createDataFrame([("en", "one two three two three")] * 3, "lang string, text string"), entries=2)
    assert model.languages == ["en"]
    lettered = {r.lang_pred: r.score for r in language.predict(odd_docs, model).collect()}
    assert lettered["en"] == 1.0 and set(lettered) <= {"en", "und"}


def test_language_score_does_not_depend_on_the_rows_beside(spark):
    rng = random.Random(4)
    word = lambda letters: "".join(rng.choices(letters, k=5))
    rows = [(x, " ".join(word(letters) for _ in range(60)) + f" rare{x}") for x, letters in (("aa", "abcdef"), ("bb", "cdefgh")) for _ in range(30)]
    model = language.train(spark.createDataFrame(rows, "lang string, text string"), entries=20)
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    whole = {r.doc_id: r.score for r in language.predict(docs.coalesce(1), model).collect()}
    alone = {r.doc_id: r.score for r in language.predict(docs.repartition(17), model).collect()}
    assert whole == alone


def test_language_with_a_thousandth_of_the_rows(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefgh", k=7))
    large, small = ([word() for _ in range(n)] for n in (150, 40))
    text_of = lambda lexicon, n: " ".join(rng.choices(lexicon, k=n))
    rows = [("aa", text_of(large, 50)) for _ in range(1998)] + [("bb", text_of(small, 50)) for _ in range(2)]
    model = language.train(spark.createDataFrame(rows, "lang string, text string"), entries=200)
    assert np.mean([model.predict(text_of(small, 12))[0] == "bb" for _ in range(50)]) >= 0.95
    assert np.mean([model.predict(text_of(large, 12))[0] == "aa" for _ in range(50)]) >= 0.95


def toxic_corpus(n=600):
    rng = random.Random(8)
    parts = ["ba", "lo", "mi", "ter", "an", "sho", "ve", "gri", "pel", "und"]
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(20, 120))]
        if toxic := i % 4 == 0:
            for _ in range(1 + len(words) // 20):
                words.insert(rng.randrange(len(words)), rng.choice(["zorkface", "quimbly", "jaxx" + rng.choice(parts), "jaxx" + rng.choice(parts)]))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_toxicity_of_held_out_documents(spark, odd_docs, no_docs):
    rows = toxic_corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = docs.select("doc_id", "toxic").where("doc_id < 400").union(spark.createDataFrame([(9999, 1), (None, 1), (0, None)], "doc_id long, toxic int"))
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    truth = {i: t for i, _, t in rows}
    held = range(400, 600)
    assert np.mean([got[i].predicted for i in held if truth[i]]) >= 0.8
    assert np.mean([got[i].predicted for i in held if not truth[i]]) <= 0.03
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    odd = toxicity.score(odd_docs, model).collect()
    assert len(odd) == 12 and len({r.score for r in odd if r.doc_id in (3, 4, 5)}) == 1 and not any(r.predicted for r in odd)
    texts = [t for _, t, _ in rows[:64]] + ["", None, "zorkface quimbly"] * 3
    features = np.array([model.features(t) for t in texts])
    alone = [model.score(x[None])[0] for x in features]
    assert alone == model.score(features).tolist() == model.score(features[::-1]).tolist()[::-1]
    assert all(model.score(features[a:b]).tolist() == alone[a:b] for a in range(0, 64, 7) for b in range(a + 1, 73, 5))
    none = toxicity.train(docs, labels.where("toxic = 0"))
    assert {r.predicted for r in toxicity.score(docs, none).collect()} == {0}
    assert toxicity.score(no_docs, none).count() == 0


def test_toxic_phrases_of_ordinary_words(spark):
    rng = random.Random(5)
    parts = ["ba", "lo", "mi", "ter", "an", "sho", "ve", "gri", "pel", "und"]
    lexicon = sorted({"".join(rng.choices(parts, k=3)) for _ in range(300)})
    phrases = [" ".join(rng.sample(lexicon, 6)) for _ in range(8)]
    rows = []
    for i in range(600):
        words = rng.choices(lexicon, k=rng.randint(30, 100))
        if toxic := i % 4 == 0:
            for _ in range(2 + len(words) // 30):
                words.insert(rng.randrange(len(words)), rng.choice(phrases))
        else:
            words += rng.choice(phrases).split()[::-1]
            rng.shuffle(words)
        rows.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.score(docs, toxicity.train(docs, docs.select("doc_id", "toxic").where("doc_id < 400"))).collect()}
    assert np.mean([got[i] for i, _, t in rows[400:] if t]) >= 0.8
    assert np.mean([got[i] for i, _, t in rows[400:] if not t]) <= 0.03


def test_windows_cover_whole_texts():
    text = "Word " * 40 + "x" * 1000 + " end"
    joined = b"".join(toxicity.windows(text)).replace(b" ", b"")
    assert joined.decode() == text.lower().replace(" ", "")
    assert max(map(len, toxicity.windows(text))) <= toxicity.LONGEST + 2 and toxicity.windows(None) == []


def test_weak_labels_find_accuracies():
    """Votes drawn from known accuracies: the estimate sorts patterns as the truth does."""
    rng = np.random.default_rng(1)
    good = rng.random(20_000) < 0.85
    hit, alarm = np.array([0.5, 0.3, 0.4, 0.6, 0.3, 0.5, 0.4, 0.3]), np.array([0.002, 0.001, 0.003, 0.002, 0.001, 0.002, 0.001, 0.004])
    bad_vote = rng.random((len(good), 8)) < np.where(good[:, None], alarm, hit)
    vote = np.where(rng.random(bad_vote.shape) < 0.1, quality.NONE, np.where(bad_vote, quality.BAD, quality.GOOD))
    patterns, where, counts = np.unique(vote @ 3 ** np.arange(8), return_inverse=True, return_counts=True)
    p = quality.weak_labels(patterns, counts.astype(float))[where]
    assert ((p >= 0.5) == good).mean() > 0.97


def test_weak_labels_outvote_a_noisy_labeller():
    """Two kinds of bad documents, told by three labellers each; another labeller says bad on one in eight of all documents."""
    rng = np.random.default_rng(2)
    kind = rng.choice(3, 30_000, p=[0.85, 0.1, 0.05])  # 0 is good
    hit = np.array([[0.002] * 8, [0.9, 0.8, 0.7, 0.01, 0.01, 0.01, 0.01, 0.01], [0.01, 0.01, 0.01, 0.9, 0.6, 0.7, 0.01, 0.01]])
    hit[:, 7] = 0.125
    vote = np.where(rng.random((len(kind), 8)) < hit[kind], quality.BAD, quality.GOOD)
    patterns, where, counts = np.unique(vote @ 3 ** np.arange(8), return_inverse=True, return_counts=True)
    is_good = quality.weak_labels(patterns, counts.astype(float))[where] >= 0.5
    assert (is_good == (kind == 0)).mean() > 0.98
    noise_alone = (vote[:, 7] == quality.BAD) & (vote[:, :7] == quality.GOOD).all(1)
    assert noise_alone.sum() > 3000 and is_good[noise_alone].all()
    assert ((vote != quality.BAD).all(1) == (kind == 0)).mean() < 0.9  # the plain rule


def test_quality_of_long_texts_and_words():
    few, prose = "alpha beta gamma ", " ".join(f"w{i % 997} of {i} and" for i in range(40_000))
    assert {quality.votes(few * n)[4] for n in (15, 600, 1000, 60_000)} == {quality.BAD}
    assert quality.votes(prose)[4] == quality.GOOD
    half = few * 20_000 + prose[:200]
    assert quality.votes(half)[4] == quality.BAD  # the whole text counts
    long = "a1" * 40
    assert quality.shape(long + "!") != quality.shape(long) and quality.shape(long + "-b") != quality.shape(long + "b")
    assert quality.shape("x" * 5000 + "!!") == "a!+" and len(quality.shape("a1" * 10_000)) <= quality.LONG_NAME
    rows = quality._WORDS.rows(f"{'x' * 70}! {'x' * 70} x!")
    names = list(quality._WORDS.shapes)
    assert [names[i] for i in quality._WORDS.shape[rows]] == ["a!", "a", "a!"]


def plain_features(text):
    """The features by a dictionary of their names, one word after the other."""
    words = text.split()
    names = [quality.shape(w) for w in words]
    found = Counter()
    for name in names:
        found[f"1 {name}"] += 1 / len(words)
    for a, b in zip(names, names[1:]):
        found[f"2 {a} {b}"] += 1 / len(words)
    found["again -1"] = sum(a == b for a, b in zip(words, words[1:])) / len(words)
    found["again -2"] = len(set(words)) / len(words)
    out = np.zeros(quality.BUCKETS)
    for name, share in found.items():
        h = xxhash.xxh64_intdigest(name.encode())
        out[h % quality.BUCKETS] += share * (1 if h >> 63 else -1)
    return out


def test_features_are_those_of_the_plain_version():
    rng = random.Random(4)
    pieces = ["the", "The", "X", "IBM", "U.S.", "12", "a1!!", "--", "word,", "end.", "é", "x" * 90, "x" * 90 + ".", "a-1" * 30, "(b)", "§§§", "²", "ǅ"]
    for _ in range(200):
        text = " ".join(rng.choice(pieces) for _ in range(rng.randrange(1, 60)))
        assert np.allclose(quality.features(text), plain_features(text), atol=1e-12)


def test_quality_keeps_prose_and_drops_junk(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    scorer = quality.train(docs)
    kept = {r.doc_id: r.keep for r in quality.score(docs, scorer).collect()}
    assert np.mean([kept[i] for i, q in labels.items() if q == 1]) >= 0.99
    assert np.mean([kept[i] for i, q in labels.items() if q == 0]) <= 0.1
    rows = quality.score(odd_docs, scorer).collect()
    assert len(rows) == 12 and {r.score for r in rows if r.doc_id in (3, 4, 5)} == {0.0}
    assert next(r.keep for r in rows if r.doc_id == 8) == 1  # a short text differs little from prose
    good = quality.keep_good(odd_docs, scorer)
    assert good.columns == odd_docs.columns and {3, 4, 5}.isdisjoint(r.doc_id for r in good.select("doc_id").collect())
    assert quality.score(no_docs, quality.train(no_docs)).count() == 0
