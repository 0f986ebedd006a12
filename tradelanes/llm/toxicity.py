"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text and one on toxic text, that is, on what in
toxic documents ordinary ones do not explain: word beginnings that occur in many different contexts there
and in far fewer elsewhere (contexts, so copies of one document count once).  Every window of a text is
compressed twice, with the ordinary dictionary alone and with both; the bytes that the toxic dictionary saves are
the window's distance.  Where no word beginning marks toxic text, the toxic dictionary is trained on windows of toxic
texts instead, and the distance is the difference of the lengths with either dictionary; both are then trained on one half of the
rows and calibrated on the other, since a dictionary knows the texts it was trained on.  A logistic calibration on labelled rows
turns a document's distances into a probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard as zs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelanes.llm.common import text_key
from tradelanes.session import stored

WINDOW = 12  # words
LONGEST = 400  # characters of a window; longer words are cut
STEM = (5, 12)  # characters of a word beginning, its leading space included
ORDINARY_BYTES, TOXIC_BYTES = 31_000, 1024  # together within the compression window
STEPS = (1, 2, 3, 4, 5, 6)  # bytes saved, from which windows are counted
FEATURES = 5 + 2 * len(STEPS)
TOXIC_ROWS, ORDINARY_ROWS, MOST_WINDOWS = 4000, 8000, 20_000  # bounds of what is learnt from


def windows(text: str | None) -> list[bytes]:
    """The whole text in windows of WINDOW lower-case words, none longer than LONGEST characters."""
    out, held, size = [], [], 0
    for word in (text or "").lower().split():
        for at in range(0, len(word), LONGEST):
            part = word[at: at + LONGEST]
            if held and (len(held) == WINDOW or size + len(part) + 1 > LONGEST):
                out.append(f" {' '.join(held)} ".encode())
                held, size = [], 0
            held.append(part)
            size += len(part) + 1
    if held:
        out.append(f" {' '.join(held)} ".encode())
    return out


def trained(samples: list[bytes], size: int) -> bytes:
    """Content of a dictionary trained on samples; with too few to train on, the samples themselves."""
    whole = b"".join(samples)
    if len(samples) < 100 or len(whole) < 8 * size:
        return whole[-size:]
    try:
        return zs.train_dictionary(size, samples, d=6, k=24).as_bytes()[-size + 512:]  # entropy tables come first
    except zs.ZstdError:
        return whole[-size:]


@lru_cache(maxsize=4)
def compressor(content: bytes) -> zs.ZstdCompressor:
    params = zs.ZstdCompressionParameters(
        strategy=zs.STRATEGY_LAZY2, min_match=4, window_log=15, chain_log=16, hash_log=16, search_log=8, target_length=24,
        write_content_size=0, write_dict_id=0)
    if not content:
        return zs.ZstdCompressor(compression_params=params)
    kept = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
    kept.precompute_compress(compression_params=params)
    return zs.ZstdCompressor(dict_data=kept, compression_params=params)


class Model:
    """Dictionaries and calibration; small and of fixed size."""

    def __init__(self, ordinary: bytes, toxic: bytes, weights: np.ndarray | None = None, centre=0.0, scale=1.0, alone: bool = False):
        """``alone``: the toxic dictionary stands against the ordinary one, not beside it."""
        self.alone = alone
        self.ordinary, self.toxic, self.weights, self.centre, self.scale = ordinary, toxic, weights, centre, scale

    def features(self, text: str | None) -> list[float]:
        plain, both = compressor(self.ordinary).compress, compressor(self.toxic if self.alone else self.toxic + self.ordinary).compress
        saved = sorted((len(plain(w)) - len(both(w)) for w in windows(text)), reverse=True) if self.toxic else []
        n, gain = len(saved), sum(s for s in saved if s > 0)
        if not n:
            return [0.0] * FEATURES
        over = [sum(s >= step for s in saved) for step in STEPS]
        return [saved[0], sum(saved[:3]) / 3, math.log1p(gain), math.log1p(n), gain / n, *map(math.log1p, over), *(c / n for c in over)]

    def score(self, features: np.ndarray) -> np.ndarray:
        """Summed row by row in one order, so a text's score does not depend on the texts beside it."""
        x = np.ascontiguousarray((features - self.centre) / self.scale)
        total = (x * self.weights[:-1]).sum(1) + self.weights[-1]
        return np.array([1 / (1 + math.exp(-t)) for t in np.clip(total, -30, 30).tolist()])


def calibrate(features: np.ndarray, label: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> tuple:
    """Weights of a logistic regression (Newton steps), with centre and scale of the features."""
    centre, scale = features.mean(0), features.std(0) + 1e-9
    x = np.c_[(features - centre) / scale, np.ones(len(features))]
    w, penalty = np.zeros(x.shape[1]), ridge * np.r_[np.ones(x.shape[1] - 1), 1e-3]
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (weight * p * (1 - p) + 1e-9)) @ x + np.diag(penalty), x.T @ (weight * (label - p)) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w, centre, scale


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (word, context, toxic) of rows (text, toxic); a context is the words before and after."""
    for batch in batches:
        seen = set()
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            w = ["", *(x[:LONGEST] for x in (text or "").lower().split()), ""]
            seen.update((b, xxhash.xxh64_intdigest(f"{a} {c}") >> 1, toxic) for a, b, c in zip(w, w[1:], w[2:]))
        rows = list(seen)
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int32())], ["word", "context", "toxic"])


def toxic_stems(rows: DataFrame, least: int = 8, ratio: float = 8.0, strength: float = 30.0) -> dict[str, int]:
    """Word beginnings that mark toxic rows (text, toxic), with the contexts they occur in.

    A beginning marks them if it has ``least`` contexts there, ``ratio`` times the rate of ordinary rows, and a
    log-likelihood ratio of ``strength`` or more; of a chain of such beginnings the longest that keeps half the contexts."""
    words = stored(rows.select("text", "toxic").mapInArrow(_contexts, "word string, context long, toxic int").distinct()
                   .groupBy("word", "toxic").agg(F.count(F.lit(1)).alias("n")), "contexts")
    total = {r.toxic: r.n for r in words.groupBy("toxic").agg(F.sum("n").alias("n")).collect()}
    if not total.get(1) or not total.get(0):
        return {}
    marked = F.concat(F.lit(" "), "word", F.lit(" "))
    last = F.least(F.length(marked), F.lit(STEM[1]))
    stems = (words.where(F.length(marked) >= STEM[0])
             .select("n", "toxic", F.explode(F.transform(F.sequence(F.lit(STEM[0]), last), lambda k: F.substr(marked, F.lit(1), k))).alias("stem"))
             .groupBy("stem").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("o")))
    both, t, o = total[0] + total[1], F.col("t"), F.col("o")
    term = lambda n, of: F.when(n > 0, n * F.log(n * both / (of * (t + o)))).otherwise(0.0)
    found = stems.where((t >= least) & (t / total[1] > ratio * (o + 0.5) / total[0]) & (2 * (term(t, total[1]) + term(o, total[0])) > strength))
    # Few by the tests above: each needs a share of the bounded rows' contexts
    n = {r.stem: r.t for r in found.collect()}
    out = {}
    for stem in sorted(n):
        if len(stem) > STEM[0] and stem[:-1] in n:
            continue
        while longer := [s for s in n if len(s) == len(stem) + 1 and s.startswith(stem) and 2 * n[s] >= n[stem]]:
            stem = max(longer, key=lambda s: (n[s], s))
        out[stem] = n[stem]
    return out


def train(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, ordinary_rows: int = ORDINARY_ROWS, seed: int = 7) -> Model:
    """Model from documents (doc_id, text) and labels (doc_id, toxic): at most ``toxic_rows`` and ``ordinary_rows`` labels,
    those of the lowest hash of the id; the calibration weighs them back to their shares.  Null ids and labels teach nothing.

    The ids are drawn from the labels alone, so no text is read for them and only drawn texts are shuffled."""
    known = (labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
             .select("doc_id", "toxic", F.xxhash64("doc_id", F.lit(seed)).alias("draw")))
    of = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not of.get(0) or not of.get(1):
        return Model(b"", b"", np.r_[np.zeros(FEATURES), 30.0 if of.get(1) else -30.0])
    drawn = [known.where(F.col("toxic") == label).orderBy("draw", "doc_id").limit(most) for label, most in ((1, toxic_rows), (0, ordinary_rows))]
    drawn = stored(drawn[0].unionByName(drawn[1]), "drawn")  # at most toxic_rows + ordinary_rows ids
    chosen = (docs.select("doc_id", "text").where("text is not null").join(F.broadcast(drawn), "doc_id")
              .withColumn("key", text_key("text")).dropDuplicates(["key", "toxic"]))
    chosen = stored(chosen.select("text", "toxic", F.pmod("key", F.lit(2)).alias("half")), "sample")
    rng = np.random.default_rng(seed)
    stems = toxic_stems(chosen)
    bag = [s.encode() for s, n in sorted(stems.items()) for _ in range(min(n, 200))]
    mixed = [b"".join(bag[i] for i in rng.choice(len(bag), 6)) for _ in range(3000)] if bag else []

    def cut_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([w for t in batch.column(0).to_pylist() for w in windows(t)], pa.binary())], ["w"])

    def drawn_windows(rows: DataFrame) -> list[bytes]:
        found = (rows.select("text").mapInArrow(cut_windows, "w binary")
                 .select("w", F.xxhash64("w", F.lit(seed)).alias("draw")).orderBy("draw", "w").limit(MOST_WINDOWS))
        return [bytes(r.w) for r in found.select("w").collect()]

    if mixed:
        model = Model(trained(drawn_windows(chosen.where("toxic = 0")), ORDINARY_BYTES), trained(mixed, TOXIC_BYTES))
    else:
        learnt, chosen = chosen.where("half = 0"), chosen.where("half = 1")
        model = Model(*(trained(drawn_windows(learnt.where(F.col("toxic") == label)), ORDINARY_BYTES) for label in (0, 1)), alone=True)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([shared.value.features(t) for t in batch.column(0).to_pylist()], pa.list_(pa.float64())), batch.column(1)], ["x", "toxic"])

    found = chosen.select("text", "toxic").mapInArrow(features, "x array<double>, toxic int").collect()
    if len({r.toxic for r in found}) < 2:  # labels of documents that are not there
        return Model(b"", b"", np.r_[np.zeros(FEATURES), -30.0])
    x, y = np.array([r.x for r in found]), np.array([r.toxic for r in found])
    weight = np.where(y == 1, of[1] / max(1, (y == 1).sum()), of[0] / max(1, (y == 0).sum()))
    model.weights, model.centre, model.scale = calibrate(x, y, weight * len(y) / weight.sum())
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from ``threshold`` on) for every input row.

    Null and empty texts have no windows and score the calibration's base value; null ids and repeated rows stay;
    texts of any length are scored whole; other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([shared.value.features(t) for t in batch.column(1).to_pylist()]).reshape(-1, FEATURES)
            s = shared.value.score(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, "doc_id long, score double, predicted int")
