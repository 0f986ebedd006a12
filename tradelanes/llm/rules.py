"""Quality rules: fixed rules, and an isolation forest on their statistics.

Fixed rules refuse texts that are too short or repeat themselves.  The other texts are judged by how odd their rule statistics
are together: every tree of the forest splits a small sample of the corpus at random statistics and values until its texts
stand alone, and a text that few splits cut off is odd.  There is a forest over all statistics and one for each of them, as
not every oddness is bad.  Their scores, from the mean path lengths, are compared with thresholds that are calibrated on all
labelled rows, one forest after the other: of all thresholds that refuse hardly any good row the one that refuses most of the
bad rows left, until none tells bad rows from good ones any more.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelanes.llm.common import text_key, utf8
from tradelanes.session import stored

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
LEAST_WORDS, MOST_REPEATED = 50, 50  # of the fixed rules: words, percent of words in repeated windows
TREES, SAMPLE = 100, 256  # the forest: trees, and texts that each is grown on
BINS = 1000  # of scores, for the calibration
MOST_LOST = 0.002  # share of the good rows that each threshold may refuse


def statistics(text: bytes) -> tuple[int, ...]:
    """COUNTS of a whole text: words (what stands between ASCII white space), their code points, symbols, lines with a word that
    equal an earlier one, words in windows of three words that occur twice or more, lines with a word."""
    words = text.split()
    if not words:
        return (0,) * len(COUNTS)
    bare = text.translate(None, SPACES)
    octets = np.frombuffer(bare, np.uint8)
    lines = [line for line in text.split(b"\n") if line.strip(SPACES)]
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    repeated = 0
    if len(ids) >= 4:  # else there are no two windows
        pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]
        _, window, times = np.unique(pairs[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
        again = times[window] > 1
        covered = np.zeros(len(ids), bool)
        for k in range(3):
            covered[k:len(ids) - 2 + k] |= again
        repeated = int(covered.sum())
    return (len(words), int(np.count_nonzero((octets & 0xC0) != 0x80)), len(bare) - len(bare.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeated, len(lines))


def rule_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key (of the text) and COUNTS for every input row.  Null texts have no words; texts of any length are read
    whole; null ids and repeated rows stay; other columns are not read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([statistics(t) for t in utf8(batch.column(2))], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(found[:, k]) for k in range(len(COUNTS)))], ["doc_id", "key", *COUNTS])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(text_col).alias("key"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, key long, " + ", ".join(f"{c} long" for c in COUNTS))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


#: What the forest looks at, from columns or arrays of COUNTS: shares, so that a text is not odd for its length.
SHARES = (("word_chars", "n_words"), ("n_symbols", "word_chars"), ("n_dup_lines", "n_lines"), ("n_repeat_words", "n_words"))
VIEWS = (tuple(range(len(SHARES))), *((k,) for k in range(len(SHARES))))  # of the forests


def shares_of(counts: dict[str, np.ndarray]) -> np.ndarray:
    return np.stack([counts[a] / np.maximum(1, counts[b]) for a, b in SHARES], 1)


def expected_path(n: int) -> float:
    """Mean path length of an unsuccessful search in a binary tree of ``n`` values."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


class Forest:
    """Random trees as arrays: node k of a tree has the children 2k + 1 and 2k + 2."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, size: int = SAMPLE, seed: int = 11):
        """``sample`` has the rows to grow on; each tree draws ``size`` of them."""
        rng = np.random.default_rng(seed)
        self.size = min(size, len(sample))
        self.depth = max(1, math.ceil(math.log2(max(2, self.size))))
        nodes = 2 ** (self.depth + 1) - 1
        self.column, self.value = np.full((trees, nodes), -1, np.int32), np.zeros((trees, nodes))
        self.path = np.zeros((trees, nodes))
        for tree in range(trees):
            rows = sample[np.sort(rng.choice(len(sample), self.size, replace=False))] if self.size else sample
            self._grow(rng, tree, 0, 0, rows)

    def _grow(self, rng: np.random.Generator, tree: int, node: int, depth: int, rows: np.ndarray) -> None:
        low, high = (rows.min(0), rows.max(0)) if len(rows) else (np.zeros(1), np.zeros(1))
        open_ = np.nonzero(high > low)[0]
        if depth == self.depth or not len(open_):
            self.path[tree, node] = depth + expected_path(len(rows))
            return
        column = int(rng.choice(open_))
        value = rng.uniform(low[column], high[column])
        self.column[tree, node], self.value[tree, node] = column, value
        left = rows[:, column] <= value
        self._grow(rng, tree, 2 * node + 1, depth + 1, rows[left])
        self._grow(rng, tree, 2 * node + 2, depth + 1, rows[~left])

    def score(self, rows: np.ndarray, at_once: int = 4096) -> np.ndarray:
        """Oddness of each row, 0 to 1: 2 to the minus mean path length over the expected one.  A row's score does not
        depend on the rows beside it."""
        out, trees = np.zeros(len(rows)), np.arange(len(self.path))
        usual = expected_path(self.size) or 1.0
        for k in range(0, len(rows), at_once):
            part = rows[k:k + at_once]
            node, each = np.zeros((len(part), len(trees)), np.int64), np.arange(len(part))[:, None]
            for _ in range(self.depth):
                column = self.column[trees, node]
                further = 2 * node + np.where(part[each, np.maximum(column, 0)] <= self.value[trees, node], 1, 2)
                node = np.where(column < 0, node, further)
            mean = np.ascontiguousarray(self.path[trees, node]).sum(1) / max(1, len(trees))
            out[k:k + at_once] = [2.0 ** (-m / usual) for m in mean.tolist()]
        return out


class Forests:
    """A forest for each of VIEWS."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, size: int = SAMPLE, seed: int = 11):
        self.each = [Forest(sample[:, view], trees, size, seed + k) for k, view in enumerate(VIEWS)]

    def score(self, rows: np.ndarray) -> np.ndarray:
        return np.stack([forest.score(rows[:, view]) for forest, view in zip(self.each, VIEWS)], 1)


def grow(stats: DataFrame, trees: int = TREES, size: int = SAMPLE, seed: int = 11) -> Forests:
    """Forests over the texts that pass the fixed rules.  They are grown on ``trees * size`` texts at most, those of the lowest
    hash over the whole corpus, copies of a text once.

    Only texts below a hash are looked at, about twice as many as are needed, and more if copies leave too few of them, so
    what tasks and the driver get does not grow with the corpus."""
    most, draw = trees * size, F.xxhash64("key", F.lit(seed))
    passed = stats.where(~base_failed())
    share = min(1.0, 2 * most / max(1, passed.count()))
    while True:
        cut = F.lit(True) if share >= 1 else draw < F.lit(int(-(1 << 63) + share * (1 << 64)))
        fit = stored(passed.where(cut).groupBy(draw.alias("draw")).agg(*[F.first(c).alias(c) for c in COUNTS]), "drawn")
        if share >= 1 or fit.count() >= most:
            break
        share = min(1.0, 4 * share)
    drawn = fit.orderBy("draw").limit(most).collect()
    counts = {c: np.array([r[c] for r in drawn], float) for c in COUNTS}
    return Forests(shares_of(counts), trees, size, seed)


def threshold(good: np.ndarray, bad: np.ndarray, of_good: float, of_bad: float, most_lost: float = MOST_LOST) -> tuple[float, float]:
    """(gain, score from which rows are refused), from counts of the good and bad labelled rows left by bin of score.  Of the
    bins from which at most ``most_lost`` of all good rows are refused, the one with most of the bad rows beyond the share
    of the good ones, the middle one of several in a row; (0, 2) (nothing is refused) if there is none."""
    lost, caught = (x[::-1].cumsum()[::-1] / max(1, n) for x, n in ((good, of_good), (bad, of_bad)))
    gain = np.where(lost <= most_lost, caught - lost, 0.0)
    if gain.max() <= 0:
        return 0.0, 2.0
    first = int(np.argmax(gain))
    same = int(np.argmax(np.append(gain[first:] != gain[first], True)))
    return float(gain[first]), (first + (same - 1) // 2) / BINS


def refused(cuts: dict[int, float]) -> Column:
    found = F.lit(False)
    for view, cut in sorted(cuts.items()):
        found = found | (F.get("scores", F.lit(view)) >= cut)
    return found


def calibrate(labelled: DataFrame, most_lost: float = MOST_LOST) -> dict[int, float]:
    """Thresholds by forest from all labelled rows (quality, scores).  What a job returns are counts for each forest, label
    and bin; there are as many jobs as forests at most.  Without rows of both labels there is no threshold."""
    cuts: dict[int, float] = {}
    total = None
    while len(cuts) < len(VIEWS):
        held = np.zeros((len(VIEWS), 2, BINS + 1))
        for r in (labelled.where(~refused(cuts)).select("quality", F.posexplode("scores").alias("view", "score"))
                  .groupBy("view", "quality", F.floor(F.col("score") * BINS).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()):
            held[r.view, 1 if r.quality else 0, r.bin] += r.n
        total = held[0].sum(1) if total is None else total
        if not total.all():
            break
        gains = [(*threshold(good, bad, total[1], total[0], most_lost), view) for view, (bad, good) in enumerate(held)]
        gain, cut, view = max(gains, key=lambda g: (g[0], -g[2]))
        if gain <= 0:
            break
        cuts[view] = min(cut, cuts.get(view, 2.0))
    return cuts


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", trees: int = TREES, size: int = SAMPLE,
          most_lost: float = MOST_LOST) -> DataFrame:
    """doc_id, COUNTS, base_failed, scores (oddness by each forest, 0 for what the fixed rules refuse) and kept for every
    input row.

    ``labels`` (doc_id, quality 0 or 1) calibrate the thresholds; all of them count, an id with several labels by its lowest, an id of
    several rows for each; null ids and labels teach nothing.  Without labels of both kinds the forests refuse nothing.
    Null and empty texts have no words and fail the fixed rules; an empty table gives no rows."""
    stats = stored(rule_statistics(docs, id_col, text_col).withColumn("base_failed", base_failed()), "statistics")
    forests = docs.sparkSession.sparkContext.broadcast(grow(stats, trees, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = {c: batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in COUNTS}
            failed = batch.column(batch.schema.get_field_index("base_failed")).to_numpy(zero_copy_only=False)
            scores = np.where(failed[:, None], 0.0, forests.value.score(shares_of(counts)))
            each = pa.ListArray.from_arrays(np.arange(len(scores) + 1, dtype=np.int32) * len(VIEWS), pa.array(scores.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, each], [*batch.schema.names, "scores"])

    kinds = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean"
    scored = stored(stats.select("doc_id", *COUNTS, "base_failed").mapInArrow(run, f"{kinds}, scores array<double>"), "odd")
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    labelled = stored(scored.where("not base_failed").join(known, "doc_id").select("quality", "scores"), "labelled")
    return scored.withColumn("kept", ~F.col("base_failed") & ~refused(calibrate(labelled, most_lost)))
