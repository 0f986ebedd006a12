"""Quality classifier: a weak-label model and a hashed linear scorer.

Heuristic labellers vote good, bad or nothing on each document, most by looking for one defect.  They overlap and err, so expectation-maximisation
estimates from the counts of all vote patterns how each labeller behaves on good and on bad documents; this gives
each pattern a probability of good.  Documents with these labels train a logistic scorer on hashed word shapes,
which also judges texts the labellers say nothing on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelanes.session import stored

BAD, GOOD, NONE = 0, 1, 2
BUCKETS = 1024  # of hashed shapes
FULL = 20  # words from which a text's shapes count in full; fewer tell less
ROWS = 4000  # documents of each weak label that the scorer learns from, at most
BLOCK = 500  # words within which words are told apart, as long texts have fewer new ones
LONG_NAME = 64  # characters of a shape's name that are kept as they are
SYMBOLS = re.compile(r"[^\w\s]{2,}$")
END = re.compile(r"[.!?]\W*$")


def _defect(share: float, most: float, enough: bool = True) -> int:
    """Bad above ``most``, else good; no vote where there is too little text to tell."""
    return NONE if not enough else BAD if share > most else GOOD


def _usual(share: float, usual: tuple, odd: tuple, enough: bool) -> int:
    """Good within the usual range, bad outside the odd one, no vote between."""
    return NONE if not enough else GOOD if usual[0] <= share <= usual[1] else BAD if not odd[0] <= share <= odd[1] else NONE


class Words(dict):
    """Word -> row of what is known of it, filled as words are met; one for each Python worker.

    ``facts`` has for each word its letters, upper-case letters, letters and digits, characters, and whether it has no
    letter or digit, ends in symbols, ends a sentence and is short; ``shape`` the number of its shape."""

    def __init__(self, room: int = 1 << 19):
        super().__init__()
        self.room, self.shapes = room, {}
        self.facts, self.shape = np.zeros((4096, 8)), np.zeros(4096, np.int64)

    def __missing__(self, word: str) -> int:
        row = self[word] = len(self)
        if row == len(self.shape):
            self.facts = np.concatenate((self.facts, np.zeros_like(self.facts)))
            self.shape = np.concatenate((self.shape, np.zeros_like(self.shape)))
        # Most words are letters and at most one mark behind them; the others are taken character by character.
        mark = word[-1] if word[-1] in ".,;:!?" else ""
        bare = word[:-1] if mark else word
        upper = 0 if bare.islower() else 1 if bare[:1].isupper() and (len(bare) == 1 or bare[1:].islower()) else None
        if upper is not None and bare.isalpha():
            self.facts[row] = len(bare), upper, len(bare), len(word), 0, 0, mark in (".", "!", "?"), len(word) <= 3
            name = ("" if not upper else "A" if len(bare) == 1 else "Aa") or "a"
            name += mark
        else:
            alnum = sum(map(str.isalnum, word))
            self.facts[row] = (sum(map(str.isalpha, word)), sum(map(str.isupper, word)), alnum, len(word), alnum == 0,
                               SYMBOLS.search(word) is not None, END.search(word) is not None, len(word) <= 3 and alnum > 0)
            name = shape(word)
        self.shape[row] = self.shapes.setdefault(name, len(self.shapes))
        return row

    def rows(self, text: str) -> np.ndarray:
        words = text.split()
        if len(self) + len(words) > self.room:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


_WORDS = Words()


def votes(text: str | None) -> list[int]:
    """What each labeller says of a text."""
    rows = _WORDS.rows(text or "")
    n = len(rows)
    if not n:
        return [NONE] * LABELLERS
    letters, upper, alnum, printed, wordless, marked, ends, short = _WORDS.facts[rows].sum(0).tolist()
    again = int((rows[1:] == rows[:-1]).sum())
    distinct = len(np.unique(np.arange(n) // BLOCK * (1 << 32) + rows))  # in each block of the text
    return [
        _defect(again / n, 0.25, n >= 10),  # the same word again and again
        _defect(marked / n, 0.25, n >= 5),  # words that end in strings of symbols
        _defect(upper / max(1, letters), 0.60, letters >= 20),  # shouting
        _defect(wordless / n, 0.15, n >= 5),  # separators between words, as in tables and menus
        _defect(1 - distinct / n, 0.90, n >= 30),  # few distinct words in a block
        _defect(1 - alnum / max(1, printed), 0.20, printed >= 20),  # few letters and digits
        _usual(n / max(1, ends), (2, 40), (1.2, 80), n >= 20),  # words in a sentence
        _usual(short / n, (0.10, 0.75), (0.03, 0.90), n >= 30),  # function words
    ]


LABELLERS = 8


def pattern(text: str | None) -> int:
    """The votes as one number in base three."""
    return sum(v * 3**i for i, v in enumerate(votes(text)))


def weak_labels(patterns: np.ndarray, counts: np.ndarray, rounds: int = 500) -> np.ndarray:
    """Probability of good for each vote pattern, by expectation-maximisation over good documents and one kind of bad ones
    for each labeller, those with its defect.  Within good documents and within a kind labellers vote independently, so what
    several say of one defect, or do not find in documents of another, is not counted as if it came from the whole of the bad ones; no
    vote is no evidence.  It starts from the kinds of the labellers that say bad, and half a vote of either sort stands beside those counted.

    A kind in which mostly no second labeller says bad is no more than its labeller's word: its documents are
    false alarms and count as good, unless other kinds have them."""
    vote = patterns[:, None] // 3 ** np.arange(LABELLERS) % 3
    said = np.stack([vote == BAD, vote == GOOD], 2).astype(float)  # patterns x labellers x votes
    bad = vote == BAD
    of = np.column_stack([np.where(bad.any(1), 0.1, 1.0), 0.9 * bad / np.maximum(1, bad.sum(1, keepdims=True))])  # good first
    for _ in range(rounds):
        weight = (of * counts[:, None]).T  # classes x patterns
        behave = np.einsum("cp,plo->clo", weight, said) + 0.5
        behave /= behave.sum(2, keepdims=True)
        fit = np.log((weight.sum(1) + 0.5) / (counts.sum() + 0.5 * len(weight))) + np.einsum("plo,clo->pc", said, np.log(behave))
        new = np.exp(fit - fit.max(1, keepdims=True))
        new /= new.sum(1, keepdims=True)
        done, of = np.abs(new - of).max() < 1e-7, new
        if done:
            break
    alone = np.prod(np.where(np.eye(LABELLERS, dtype=bool), 1.0, behave[1:, :, 1]), axis=1)  # chance that no other says bad
    return of[:, 0] + of[:, 1:] @ (alone >= 0.5)


def shape(word: str) -> str:
    """Kinds of characters of the whole word in order, runs as one: letters a or A, digits 9, marks as they are.  A hash stands
    for a long name, so what a worker keeps does not grow with the words."""
    kinds = ("A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c for c in word)
    name = "".join(k + ("+" if len(list(run)) > 1 and k not in "aA9" else "") for k, run in groupby(kinds))
    return name if len(name) <= LONG_NAME else f"long {xxhash.xxh64_hexdigest(name.encode())}"


class Slots(dict):
    """Number of a shape, or of a pair of neighbouring shapes -> bucket and sign of its feature."""

    def __init__(self, room: int = 1 << 18):
        super().__init__()
        self.room = room

    def of(self, keys: np.ndarray, names) -> tuple[np.ndarray, np.ndarray]:
        if len(self) > self.room:
            self.clear()
        found = []
        for key in keys.tolist():
            if (slot := self.get(key)) is None:
                h = xxhash.xxh64_intdigest(names(key).encode())
                slot = self[key] = h % BUCKETS, 1 if h >> 63 else -1
            found.append(slot)
        both = np.array(found, np.int64).reshape(-1, 2)
        return both[:, 0], both[:, 1]


_SHAPES, _PAIRS = Slots(), Slots()  # of this Python worker, by the shape numbers of _WORDS
_MORE = 1 << 31  # over any number of shapes


def features(text: str | None) -> np.ndarray:
    """Hashed features of a text: shares of word shapes, of neighbouring shapes, of repeated and of distinct words."""
    rows = _WORDS.rows(text or "")
    out, n = np.zeros(BUCKETS), len(rows)
    if not n:
        return out
    if len(_WORDS.shapes) > _WORDS.room:  # shape numbers start anew
        for kept in (_WORDS, _WORDS.shapes, _SHAPES, _PAIRS):
            kept.clear()
        rows = _WORDS.rows(text)
    shapes = _WORDS.shape[rows]
    if len(_NAMES) != len(_WORDS.shapes):
        _NAMES[:] = _WORDS.shapes
    pairs = shapes[:-1] * _MORE + shapes[1:]
    for keys, slots, name in ((shapes, _SHAPES, lambda k: f"1 {_NAMES[k]}"), (pairs, _PAIRS, lambda k: f"2 {_NAMES[k // _MORE]} {_NAMES[k % _MORE]}")):
        distinct, counts = np.unique(keys, return_counts=True)
        at, sign = slots.of(distinct, name)
        np.add.at(out, at, sign * counts / n)
    at, sign = _SHAPES.of(np.array([-1, -2]), lambda k: f"again {k}")
    np.add.at(out, at, sign * [(rows[1:] == rows[:-1]).sum() / n, len(np.unique(rows)) / n])
    return out


_NAMES: list[str] = []  # shapes by number


class Scorer:
    """Linear on features less their centre; a text of fewer than FULL words differs from the centre by less."""

    def __init__(self, weights: np.ndarray, base: float, centre: np.ndarray):
        self.weights, self.base, self.centre = weights, base, centre

    def score(self, text: str | None) -> float:
        """Probability that a text is good; 0 without words."""
        n = len((text or "").split())
        if not n:
            return 0.0
        x = (features(text) - self.centre) * min(1.0, n / FULL)
        return float(1 / (1 + np.exp(-np.clip(x @ self.weights + self.base, -30, 30))))


def fit(x: np.ndarray, p: np.ndarray, weight: np.ndarray, ridge: float = 1e-4, rounds: int = 400) -> Scorer:
    """Logistic regression on probabilities as labels, by gradient steps with momentum (Nesterov).  Centres ``x`` in place."""
    weight = (weight / weight.sum()).astype(x.dtype)
    centre = weight @ x
    x -= centre
    w, b = np.zeros(x.shape[1]), 0.0
    rate = 4 / (np.einsum("nd,nd,n->", x, x, weight) + 1 + ridge)
    vw, vb = w.copy(), b
    for k in range(rounds):
        error = weight * (1 / (1 + np.exp(-np.clip(x @ vw.astype(x.dtype) + vb, -30, 30))) - p)
        nw, nb = vw - rate * (x.T @ error.astype(x.dtype) + ridge * vw), vb - rate * error.sum()
        vw, vb = nw + k / (k + 3) * (nw - w), nb + k / (k + 3) * (nb - b)
        w, b = nw, nb
    return Scorer(w, b, centre)


def train(docs: DataFrame, rows_each: int = ROWS, seed: int = 3, id_col: str = "doc_id", text_col: str = "text") -> Scorer:
    """Scorer for a corpus.  Votes are counted over all documents (at most 3 ** LABELLERS patterns); the scorer
    learns from at most ``rows_each`` documents of each weak label, those of the lowest hash of id and text."""
    @F.pandas_udf("int")
    def pattern_of(texts: pd.Series) -> pd.Series:
        return texts.map(pattern)

    drawn = F.xxhash64(F.col(id_col), F.col(text_col), F.lit(seed))
    judged = stored(docs.select(drawn.alias("draw"), pattern_of(F.coalesce(F.col(text_col), F.lit(""))).alias("pattern")), "votes")
    counted = judged.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").collect()
    if not counted:
        return Scorer(np.zeros(BUCKETS), 0.0, np.zeros(BUCKETS))
    patterns, counts = (np.array([r[c] for r in counted], dtype) for c, dtype in (("pattern", np.int64), ("n", float)))
    labels = weak_labels(patterns, counts)
    spark = docs.sparkSession
    known = F.broadcast(spark.createDataFrame([(int(k), float(v)) for k, v in zip(patterns, labels)], "pattern int, p double"))
    labelled = judged.join(known, "pattern")
    shares = {good: float(counts[(labels >= 0.5) == good].sum()) for good in (False, True)}
    cuts = {}
    for good in (False, True):
        lowest = labelled.where((F.col("p") >= 0.5) == good).select("draw").orderBy("draw").limit(rows_each)
        cuts[good] = lowest.agg(F.max("draw")).first()[0]
    limit = lambda good: F.lit(cuts[good] if cuts[good] is not None else -(1 << 63)).cast("long")
    chosen = labelled.where(F.col("draw") <= F.when(F.col("p") >= 0.5, limit(True)).otherwise(limit(False))).groupBy("draw").agg(F.first("p").alias("p"))
    few = docs.select(drawn.alias("draw"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "draw").dropDuplicates(["draw"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t).astype(np.float32) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes() for v in x], pa.binary()), batch.column(1)], ["x", "p"])

    sample = few.select("text", "p").mapInArrow(hashed, "x binary, p double").collect()
    x = np.array([np.frombuffer(r.x, np.float32) for r in sample]).reshape(-1, BUCKETS)
    p = np.array([r.p for r in sample])
    del sample
    good = p >= 0.5
    weight = np.where(good, shares[True] / max(1, good.sum()), shares[False] / max(1, (~good).sum()))
    return fit(x, p, weight)


def score_column(docs: DataFrame, scorer: Scorer, text_col: str = "text") -> Column:
    """Probability of good, 0 to 1, for a column of whole texts; 0 for null texts and texts without words."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(shared.value.score)

    return of(F.coalesce(F.col(text_col), F.lit("")))


def score(docs: DataFrame, scorer: Scorer, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score and keep (1 from ``threshold`` on) for every input row, repeats and null ids included; null and empty texts
    score 0, long ones are read whole, other columns are not looked at, an empty table gives no rows."""
    scored = docs.select(F.col(id_col).alias("doc_id"), score_column(docs, scorer, text_col).alias("score"))
    return scored.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("keep"))


def keep_good(docs: DataFrame, scorer: Scorer, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The input rows, with all their columns, that score ``threshold`` or more: none of null or empty text, equal texts alike."""
    return docs.where(score_column(docs, scorer, text_col) >= threshold)
