"""Document fingerprints: I-Match over several randomised lexicons.

The lexicon has the terms whose inverse document frequency lies in a band, whatever the size of the corpus: rare terms (typing
errors, cut words) and terms of every other document say little about which document it is.  Each of several
lexicons keeps a random part of it, some a quarter, some one in five hundred, so short and long documents both have lexicons
that hold a handful of their terms.  A document's distinct terms in a lexicon are sorted and hashed; the fingerprint
is the row of hashes.  Documents agree on a lexicon if its hash is equal, and the share of lexicons, among those where
either has a term, is their likeness.  A text without any term of the lexicon is hashed by all its own terms, so two such
texts are alike only with the same terms; these hashes are even, those of lexicon terms odd.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelanes.llm.common import text_key, word_counts
from tradelanes.session import stored

LEXICONS = 64
LEVELS = 8  # lexicon i keeps a term with chance 1 / 2 ** (2 + i % LEVELS)
DIGITS = 8  # hexadecimal digits of one lexicon's hash
EMPTY = "0" * DIGITS  # no term of the lexicon
ODD = "13579bdf"  # last digits of the hashes of lexicon terms
RARE, COMMON = 1 / 500, 1 / 4  # least and largest share of documents that a term may be in: the idf band
SEED = 11
MARKS = ".,;:!?\"'()[]{}|"


def terms(text: str) -> set[int]:
    """Keys of the distinct lower-case words between white space, without the marks around them."""
    words = {x.strip(MARKS) for x in text.lower().split()}
    words.discard("")
    return {xxhash.xxh64_intdigest(w, SEED) - (1 << 63) for w in words}


class Lexicons:
    """The term keys of the band, in order, with the lexicons that each is in."""

    def __init__(self, band: list[int]):
        keys = np.array(sorted(band), np.int64)
        self.row = {t: i for i, t in enumerate(keys.tolist())}
        self.keys = keys
        draw = [[xxhash.xxh32_intdigest(k.tobytes(), SEED + 1 + i) for i in range(LEXICONS)] for k in keys]
        self.within = np.array(draw, np.uint64).reshape(-1, LEXICONS) < np.array([2 ** (30 - i % LEVELS) for i in range(LEXICONS)], np.uint64)

    def fingerprint(self, text: str | None) -> str:
        own = terms(text or "")
        found = sorted(i for t in own if (i := self.row.get(t)) is not None)
        rows = np.array(found, np.int64)
        lexicon, at = np.nonzero(self.within[rows].T)  # by lexicon, in each by key
        kept, ends = self.keys[rows[at]].tobytes(), np.searchsorted(lexicon, np.arange(LEXICONS + 1)) * 8
        cuts = ends.tolist()
        out = [f"{xxhash.xxh32_intdigest(kept[a:b], SEED) | 1:0{DIGITS}x}" if a < b else EMPTY for a, b in zip(cuts, cuts[1:])]
        if text and out.count(EMPTY) == LEXICONS:
            whole = np.array(sorted(own), np.int64).tobytes() or text.encode()
            out = [f"{xxhash.xxh32_intdigest(whole, SEED + 1 + i) & ~1 | 2:0{DIGITS}x}" for i in range(LEXICONS)]
        return "".join(out)


def likeness(a: str, b: str) -> float:
    """Share of lexicons with equal hashes among those where either side has a term.  Without any, 1 if the fingerprints
    are equal, else 0."""
    parts = [(a[i: i + DIGITS], b[i: i + DIGITS]) for i in range(0, len(a), DIGITS)]
    told = [x == y for x, y in parts if x[-1] in ODD or y[-1] in ODD]
    return sum(told) / len(told) if told else float(a == b)


def band(docs: DataFrame, text_col: str = "text", rare: float = RARE, common: float = COMMON) -> list[int]:
    """Terms of the band, counted over all documents: those that at least ``rare`` and at most ``common`` of the documents with a text
    hold, and two documents at least.

    A document with d distinct terms adds to d counts, so at most d / ``rare`` terms reach ``rare`` of all documents, d their mean:
    some 150,000 for documents of 300 terms, however many documents there are, which the driver and every task can hold."""
    rows = docs.select(F.lit(0).alias("all"), F.col(text_col).alias("text"))
    counts = stored(word_counts(rows, "all", terms, "long", 500_000).where("n > 1").select("word", "n"), "term_documents")
    n = docs.where(F.length(text_col) > 0).count()
    kept = counts.where((F.col("n") >= rare * n) & (F.col("n") <= max(2, common * n))).select("word")
    return [r.word for r in kept.collect()]


def fingerprints(docs: DataFrame, lexicons: Lexicons, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint of every input row; null and empty texts have an empty one, texts of any length are read whole."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicons)

    @F.pandas_udf("string")
    def of(texts):
        return texts.map(shared.value.fingerprint)

    return docs.select(F.col(id_col).alias("doc_id"), of(F.coalesce(F.col(text_col), F.lit(""))).alias("fingerprint"))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (part, last, doc_id, key, packed): every document in one of as many parts as there are shuffle partitions,
    by ascending id, and the first document of the following part (of all, for the last part) once more as a ``last``
    row.  Sorted by last, id and key, every other row of a part stands before its next document.

    Null ids come first and equal ids stand by text key.  The cuts are found from the ids alone; each text is
    shuffled once, packed with zstandard."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.agg(F.percentile_approx(id_col, [i / parts for i in range(1, parts)] or [1.0], max(10_000, 20 * parts)),
                   F.min(id_col), F.count(F.lit(1)) - F.count(id_col)).first()
    # Cuts are ids that occur, so a part begins with the documents of its cut.
    cuts = sorted({c for c in ids[0] or [] if c > ids[1]}) if parts > 1 else []
    heads, first = set(cuts), None if ids[2] else ids[1]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        marks = np.array(cuts, np.int64)
        for batch in batches:
            out = []
            for i, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                packed = pack((text or "").encode())
                part = 0 if i is None else int(np.searchsorted(marks, i, "right"))
                out.append((part, False, i, key, packed))
                if i in heads:
                    out.append((part - 1, True, i, key, packed))
                if i == first:
                    out.append((len(cuts), True, i, key, packed))
            yield pa.RecordBatch.from_pylist([dict(zip(kind.names, r)) for r in out], kind)

    kind = pa.schema([("part", pa.int32()), ("last", pa.bool_()), ("doc_id", pa.int64()), ("key", pa.int64()), ("packed", pa.binary())])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(F.coalesce(F.col(text_col), F.lit(""))).alias("key"), F.col(text_col).alias("text"))
    dealt = rows.mapInArrow(deal, "part int, last boolean, doc_id long, key long, packed binary")
    return dealt.repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions("part", "last", "doc_id", "key")


def edited(text: str, following: str) -> str:
    """The last half of the code points, rounded down, replaced by as many of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def near_report(docs: DataFrame, lexicons: Lexicons, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every input row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next
    (likeness to its edited text and to the next document).

    Null texts count as empty; equal ids stand by text key, null ids come first; repeated rows come back as often as
    they came; a single document is its own next; texts of any length are read whole; other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicons)

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, of = zstandard.ZstdDecompressor().decompress, shared.value.fingerprint
        before = None
        for batch in batches:
            out = []
            for part, last, i, packed in zip(*(batch.column(c).to_pylist() for c in ("part", "last", "doc_id", "packed"))):
                if before and before[1] and before[0] == part:
                    continue  # further documents with the id of the following part's first
                text = unpack(packed).decode()
                row = (part, last, i, text, of(text))
                if before and before[0] == part:
                    new = edited(before[3], text)
                    mark = of(new)
                    out.append((before[2], len(before[3]), hashlib.sha256(new.encode()).hexdigest(), before[4], mark,
                                likeness(before[4], mark), likeness(before[4], row[4])))
                before = row
            yield pa.RecordBatch.from_pylist([dict(zip(kind.names, r)) for r in out], kind)

    kind = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                      ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    return with_next(docs, id_col, text_col).mapInArrow(
        report, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
