"""Language identification, words first.

A known word scores its log frequency in each language.  A word that is not known falls back to the
longest character n-grams that are known, then to shorter ones, each step at a fixed discount.
Frequencies come from all training rows, and every word that occurs twice in these is known, so what is learnt grows with the corpus.  Words whose share of the
counts of some language reaches 1 / ``entries``, at most ``entries`` for each language, are held by every task, and so are such
n-grams.  All other words are a stored table: a document is scored as if it knew none of them, its words that may be there
(a Bloom filter of fixed size spares most that are not) are joined with the table, and those that are correct the score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelanes.llm.common import word_counts
from tradelanes.session import stored

UNKNOWN = "und"
UNIT = 1 << 24  # steps of 1 in a correction: whole numbers, whose sum does not depend on the order
RUN = 1 << 14  # words by text that are scored in one step
WORD = re.compile(r"[^\W\d_]+")
GRAMS = (4, 3, 2, 1)  # lengths of n-grams, in the order of falling back
BACK = np.log(0.4)  # discount of each step back
FILTER_BITS = 25  # of the Bloom filter's size: 4 MB; a larger table makes it let more words through, not fewer
INDEPENDENT = 10  # words of a text that count in full: the words of a long one are not independent


def words(text: str) -> list[str]:
    """Lower-case runs of letters."""
    return WORD.findall(text.lower())


def grams(word: str, n: int) -> list[str]:
    """n-grams of a word between marks for its start and end."""
    marked = f"^{word}$" if n > 1 else word
    return [marked[i: i + n] for i in range(len(marked) - n + 1)]


class Model:
    """Log frequencies by language for words and for n-grams of each length."""

    def __init__(self, languages: list[str], counts: dict[int, tuple[list[str], np.ndarray]], totals: dict[int, np.ndarray], remember: int = 300_000):
        """``counts`` has for words (0) and each n-gram length the entries and a row of counts by language for each;
        ``totals`` the counts of all words or n-grams, known or not, by language."""
        self.languages, self.remember = languages, remember
        self.totals = totals
        self.rare, self.bits = None, None  # the stored table of the words that the tables here lack, and its filter
        self.seen = None  # scores of the words met so far, in the worker that meets them
        self.row, self.logs, self.floor = {}, {}, {}
        for n, (entries, found) in counts.items():
            # Add-half smoothing: an entry of one language leaves a little for the others
            whole = totals[n] + 0.5 * (len(entries) + 1)
            self.row[n] = {e: i for i, e in enumerate(entries)}
            self.logs[n] = np.log((found + 0.5) / whole).astype(np.float32)
            self.floor[n] = np.log(0.5 / whole)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "rare": None, "seen": None}  # tasks have no use for a table

    def known(self, n: int, entry: str) -> np.ndarray | None:
        at = self.row[n].get(entry)
        return None if at is None else self.logs[n][at]

    def word(self, word: str) -> np.ndarray:
        known = self.known(0, word)
        return known if known is not None else self.backoff(word, 0)

    def backoff(self, word: str, step: int) -> np.ndarray:
        """Mean over the word's n-grams; n-grams that are not known go to the next shorter length."""
        n = GRAMS[step]
        parts = grams(word, n)
        shorter = step + 1 < len(GRAMS)
        if not parts:
            return BACK + (self.backoff(word, step + 1) if shorter else self.floor[n])
        rows = [self.row[n].get(p) for p in parts]
        total = self.logs[n][[r for r in rows if r is not None]].sum(0, dtype=float)
        for part, r in zip(parts, rows):
            if r is None:
                total += BACK + (self.backoff(part.strip("^$") or part, step + 1) if shorter else self.floor[n])
        return total / len(parts)

    def evidence(self, texts: Iterator[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """What texts say by the tables held here, in runs of some texts: for each the sum of its words' scores, its words with a
        letter, and how many of the keys and counts that follow are its own: of its words that the stored table may know."""
        run, size = [], 0
        for text in texts:
            run.append(Counter(words(text)))
            size += len(run[-1])
            if size >= RUN:
                yield self.evidence_of(run)
                run, size = [], 0
        if run:
            yield self.evidence_of(run)

    def evidence_of(self, run: list[Counter]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        sizes = [len(c) for c in run]
        if self.seen is None or self.seen.full(sum(sizes)):
            self.seen = Seen(self, max(self.remember, sum(sizes)))
        seen = self.seen
        rows = np.array(seen.rows([w for c in run for w in c]), np.int64)
        n = np.fromiter((k for c in run for k in c.values()), float, len(rows))
        text = np.repeat(np.arange(len(run)), sizes)
        lettered = np.bincount(text, n * seen.lettered[rows], len(run))
        total = np.zeros((len(run), len(self.languages)))
        for i in range(len(self.languages)):
            total[:, i] = np.bincount(text, n * seen.scores[rows, i], len(run))
        keys = seen.keys[rows]
        other = np.nonzero((keys != 0) & (lettered[text] > 0))[0]
        return total, lettered, np.bincount(text[other], minlength=len(run)), keys[other], n[other].astype(np.int32)

    def predict(self, text: str) -> tuple[str, float]:
        """Language and score by the tables held here alone."""
        total, lettered, *_ = next(self.evidence([text]))
        if not lettered[0] or not self.languages:
            return UNKNOWN, 0.0
        total = total[0] / max(1.0, lettered[0] / INDEPENDENT)
        best = int(np.argmax(total))
        return self.languages[best], float(1 / np.exp(total - total[best]).sum())


def key_of(word: str) -> int:
    """64-bit key of a word in the stored table; never 0."""
    return (xxhash.xxh64_intdigest(word) - (1 << 63)) or 1


def filter_bits(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a key in the filter."""
    mask = (1 << FILTER_BITS) - 1
    return keys & mask, keys >> FILTER_BITS & mask


def key_filter(rare: DataFrame) -> np.ndarray:
    """The filter of all keys of the stored table, set by pieces of 4 KB that are merged by aggregation: at most all pieces of its
    fixed size reach the driver."""
    mask = F.lit((1 << FILTER_BITS) - 1).cast("long")
    bits = F.explode(F.array(F.col("key").bitwiseAND(mask), F.shiftright("key", FILTER_BITS).bitwiseAND(mask)))
    pieces = rare.select(bits.alias("bit")).select((F.col("bit") + 1).alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("set"))
    out = np.zeros(1 << FILTER_BITS >> 3, np.uint8)
    for r in pieces.collect():
        part = np.frombuffer(r["set"], np.uint8)
        out[(r.piece - 1) * len(part):r.piece * len(part)] = part
    return out


class Grams(dict):
    """Longest n-gram -> row of its scores, each with its way back to shorter ones walked once."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.scores = model, np.zeros((1024, len(model.languages)))

    def __missing__(self, gram: str) -> int:
        row = self[gram] = len(self)
        if row == len(self.scores):
            self.scores = np.concatenate((self.scores, np.zeros_like(self.scores)))
        known = self.model.known(GRAMS[0], gram)
        self.scores[row] = known if known is not None else BACK + self.model.backoff(gram.strip("^$") or gram, 1)
        return row


class Seen:
    """Scores of the words met so far, with room for a given number.

    Scores are less their mean, so common and rare words weigh by what they tell; words without a letter score nothing."""

    def __init__(self, model: Model, room: int):
        self.model, self.room, self.row, self.grams = model, room, {}, Grams(model)
        self.scores = np.zeros((room, len(model.languages)))
        self.lettered = np.zeros(room)
        self.keys = np.zeros(room, np.int64)  # of words that the held table lacks, else 0

    def full(self, more: int) -> bool:
        return len(self.row) + more > self.room or len(self.grams) > self.room

    def rows(self, words) -> list[int]:
        row = self.row
        if new := list(dict.fromkeys(w for w in words if w not in row)):
            at = range(len(row), len(row) + len(new))
            row.update(zip(new, at))
            self.lettered[at.start: at.stop] = [w.isalpha() or any(map(str.isalpha, w)) for w in new]
            known = [self.model.row[0].get(w) for w in new]
            scores = np.zeros((len(new), len(self.model.languages)))
            old = [i for i, k in enumerate(known) if k is not None]
            scores[old] = self.model.logs[0][[known[i] for i in old]]
            fresh = [i for i, k in enumerate(known) if k is None]
            keys = np.array([0 if k is not None else key_of(w) for w, k in zip(new, known)], np.int64)
            if self.model.bits is not None:
                keys[~np.logical_and(*(self.model.bits[p >> 3] >> (p & 7) & 1 for p in filter_bits(keys)))] = 0
            self.keys[at.start: at.stop] = keys
            if fresh:
                size, grams = GRAMS[0], self.grams
                parts = [[grams[m[j: j + size]] for j in range(max(1, len(m) - size + 1))] for m in (f"^{new[i]}$" for i in fresh)]
                counts = np.array([len(p) for p in parts])
                flat = grams.scores[[r for p in parts for r in p]]
                scores[fresh] = np.add.reduceat(flat, np.concatenate(([0], np.cumsum(counts)[:-1])), axis=0) / counts[:, None]
            self.scores[at.start: at.stop] = (scores - scores.mean(1, keepdims=True)) * self.lettered[at.start: at.stop, None]
        return [row[w] for w in words]


def frequent(counts: DataFrame, whole: dict[str, int], entries: int) -> DataFrame:
    """Rows (word, by) of the words whose share of the counts of any one language is at least 1 / entries: at most ``entries`` words for
    each language.  ``whole`` has the counts of all words of each."""
    if not whole:
        return counts.limit(0)
    of = F.create_map(*(F.lit(x) for pair in whole.items() for x in pair))
    return counts.where(F.exists(F.map_entries("by"), lambda e: e["value"] * entries >= of[e["key"]]))


def by_language(counts: DataFrame) -> DataFrame:
    """(word, by) of rows (lang, word, n): the counts of a word by language in one row."""
    return counts.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"))


def totals_of(counts: DataFrame) -> dict[str, int]:
    """Language -> counts of all its words, languages in order."""
    found = counts.select(F.explode("by").alias("lang", "n")).groupBy("lang").agg(F.sum("n").alias("n")).collect()
    return dict(sorted((r.lang, r.n) for r in found))


def matrix_of(found: DataFrame, at: dict[str, int]) -> tuple[list[str], np.ndarray]:
    """Words of rows (word, by) and their counts, a column for each language."""
    rows = found.toArrow()
    matrix = np.zeros((rows.num_rows, len(at)), np.float32)
    start = 0
    for by in rows["by"].chunks:
        row = start + np.repeat(np.arange(len(by)), np.diff(by.offsets.to_numpy()))
        matrix[row, [at[x] for x in by.keys.to_pylist()]] = by.items.to_numpy()
        start += len(by)
    return rows["word"].to_pylist(), matrix


def pieces(n: int) -> Column:
    """All n-grams of a word, as ``grams`` has them."""
    marked = F.concat(F.lit("^"), "word", F.lit("$")) if n > 1 else F.col("word")
    places = F.sequence(F.lit(1), F.length(marked) - n + 1)
    return F.when(F.length(marked) >= n, F.transform(places, lambda i: F.substr(marked, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def train(rows: DataFrame, entries: int = 1 << 17) -> Model:
    """Model from rows (lang, text); null languages and texts teach nothing.  The tables sent to the
    driver have, for each language, at most ``entries`` words and as many n-grams of each length; all other words stay in a
    stored table."""
    # Dealt by word alone, so the counts of a word in all languages are in one place from the first shuffle on
    counts = word_counts(rows.where("lang is not null and text is not null"), "lang", words, held=500_000, by_word=True)
    counts = stored(by_language(counts), "language_words")
    spread = counts.select(F.explode(F.concat(*map(pieces, GRAMS))).alias("word"), "by").select("word", F.explode("by").alias("lang", "n"))
    grams_by = stored(by_language(spread.groupBy("word", "lang").agg(F.sum("n").alias("n"))), "language_grams")
    parts = {0: counts, **{n: grams_by.where(F.length("word") == n) for n in GRAMS}}
    whole = {n: totals_of(part) for n, part in parts.items()}
    languages = list(whole[0])
    at = {lang: i for i, lang in enumerate(languages)}
    totals = {n: np.array([found.get(lang, 0) for lang in languages], float) for n, found in whole.items()}
    tables = {n: matrix_of(frequent(part, whole[n], entries), at) for n, part in parts.items()}
    model = Model(languages, tables, totals)
    model.rare = corrections(counts, model)
    model.bits = key_filter(model.rare)
    return model


def corrections(counts: DataFrame, model: Model) -> DataFrame:
    """The stored table: key and c0, c1, ... of every word counted twice (word, by) that the model's own table lacks: by how much
    its score in each language but the last differs from what falling back to n-grams gives, less the same of the last, in
    steps of 1 / UNIT.  Only differences between languages count in a prediction."""
    at = {lang: i for i, lang in enumerate(model.languages)}
    shared = counts.sparkSession.sparkContext.broadcast(model)
    names = ["key", *(f"c{i}" for i in range(len(at) - 1))]

    def correct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        whole = held.totals[0] + 0.5 * (len(held.row[0]) + 1) if held.languages else 0
        for batch in batches:
            keys, found, by = [], [], []
            for word, ns in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if word not in held.row[0]:
                    keys.append(key_of(word))
                    found.append(word)
                    by.append(ns)
            if not keys:
                continue
            n = np.zeros((len(keys), len(at)))
            for i, ns in enumerate(by):
                for lang, c in ns:
                    n[i, at[lang]] = c
            logs = np.log((n + 0.5) / whole)
            seen = Seen(held, len(found))
            scores = logs - logs.mean(1, keepdims=True) - seen.scores[seen.rows(found)]
            steps = np.rint((scores - scores[:, -1:]) * UNIT).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *(pa.array(steps[:, i].copy()) for i in range(len(at) - 1))], names)

    twice = counts.where(F.aggregate(F.map_values("by"), F.lit(0).cast("long"), lambda a, x: a + x) > 1).select("word", "by")
    return stored(twice.mapInArrow(correct, ", ".join(["key long", *(f"{c} long" for c in names[1:])])), "language_rare")


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score (share of the best language, 0 to 1) for every input row.

    Null texts and texts without a letter, and all texts if nothing was learnt, are ``und`` with score 0.
    Equal scores go to the first language in order; null ids and repeated rows stay; texts of any length are read whole; other columns
    are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    size = range(len(model.languages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(shared.value.evidence(t or "" for t in batch.column(1).to_pylist()))
            if not found:
                continue
            total, lettered, asked, keys, ns = (np.concatenate(x) for x in zip(*found))
            ends = np.concatenate(([0], np.cumsum(asked))).astype(np.int32)
            listed = pa.ListArray.from_arrays(np.arange(len(total) + 1, dtype=np.int32) * len(size), total.ravel(), mask=pa.array(lettered == 0))
            yield pa.RecordBatch.from_arrays([batch.column(0), listed, pa.array(lettered), pa.ListArray.from_arrays(ends, keys), pa.ListArray.from_arrays(ends, ns)],
                                             ["doc_id", "total", "lettered", "keys", "ns"])

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(
        run, "doc_id long, total array<double>, lettered double, keys array<long>, ns array<int>")
    if not model.languages:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "language_evidence")
    # One row for each document and word, however often it occurs there; a word of many documents is a skewed key of the join
    asked = rows.select("row", F.explode(F.arrays_zip("keys", "ns")).alias("w")).select("row", F.col("w.keys").alias("key"), F.col("w.ns").alias("n"))
    fixes = asked.join(model.rare, "key").groupBy("row").agg(F.sum("n").alias("known"), *[F.sum(F.col("n") * F.col(f"c{i}")).alias(f"c{i}") for i in size[:-1]])
    fix = [F.coalesce(F.col(f"c{i}") / UNIT, F.lit(0.0)) for i in size[:-1]] + [F.lit(0.0)]
    each = F.array(*[(F.col("total")[i] + fix[i]) / F.greatest(F.lit(1.0), F.col("lettered") / INDEPENDENT) for i in size])
    out = rows.select("row", "doc_id", "total", "lettered").join(fixes, "row", "left").select("doc_id", F.col("total").isNotNull().alias("told"), each.alias("each"))
    best = F.array_max("each")
    share = 1 / F.aggregate("each", F.lit(0.0), lambda a, x: a + F.exp(x - best))
    named = F.element_at(F.array(*[F.lit(name) for name in model.languages]), F.array_position("each", best).cast("int"))
    return out.select("doc_id", F.when(F.col("told"), named).otherwise(UNKNOWN).alias("lang_pred"), F.when(F.col("told"), share).otherwise(0.0).alias("score"))
