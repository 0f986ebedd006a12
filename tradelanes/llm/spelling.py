"""Spelling variants of the words of a corpus, by blocked Gram matrices.

A word is the vector of its letter counts.  One inserted or deleted letter moves it by a squared distance of 1, a replaced
one by 2, so near words have a squared distance of at most 2 and lengths that differ by at most one.  Distances of
whole blocks come from one matrix product, |a|^2 + |b|^2 - 2ab; pairs at most 2 apart are then verified letter by letter.

A block holds words of one length whose counts over CLASSES classes of letters agree.  A near word's class counts differ
in one class by one, or in two by one each, so a block meets itself and few others, and no pair is lost.  Large blocks
are dealt to chunks of about CHUNK words; a chunk meets the other chunks of its block like those of neighbouring blocks.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelanes.llm.common import utf8
from tradelanes.session import stored

CLASSES = 6
CHUNK = 256  # words of a chunk, about
HELD = 200_000  # words that a task counts before it passes the counts on
LETTERS = 26 + 64  # a to z, U+00C0 to U+00FF


def runs(text: bytes, least_chars: int) -> list[str]:
    """Runs of at least ``least_chars`` letters of a whole text; only A to Z are lower-cased (as bytes.lower does)."""
    return re.findall("[a-zÀ-ÿ]{%d,}" % least_chars, text.lower().decode(errors="replace"))


def vocabulary(docs: DataFrame, drop_one_in: int | None = None, least_chars: int = 7, least: int = 2, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(word, n): the words of at least ``least_chars`` letters that occur ``least`` times or more in all texts.

    With ``drop_one_in``, runs whose crc32 of ``<id>:<run>`` it divides lose the letter at that number modulo their
    length, in all places of the document (spelling errors, made).  Null and empty texts have no words, a null id
    reads as ''; repeated rows count each; texts of any length are read whole; other columns are not read."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.int64())], ["word", "n"])
            sums.clear()
            return out

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                found = Counter(runs(text, least_chars))
                if drop_one_in is None:
                    sums.update(found)
                else:
                    for word, n in found.items():
                        h = zlib.crc32(f"{key}:{word}".encode())
                        if h % drop_one_in == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                        if len(word) >= least_chars:
                            sums[word] += n
                if len(sums) > HELD:
                    yield flush()
        if sums:
            yield flush()

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    parts = rows.where("text is not null").mapInArrow(count, "word string, n long")
    return stored(parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "vocabulary")


def letters(words: list[str]) -> np.ndarray:
    """Letters of words of one length as numbers, one row a word."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    return np.where(points < 128, points - ord("a"), points - 0xC0 + 26).reshape(len(words), -1)


def counts_of(spelled: np.ndarray) -> np.ndarray:
    """Letter counts of each row, in single precision where products of them are exact in it."""
    n, length = spelled.shape
    exact = np.float32 if length < 2900 else np.float64  # 2 * 2900^2 < 2^24
    flat = np.bincount((np.arange(n)[:, None] * LETTERS + spelled).ravel(), minlength=n * LETTERS)
    return flat.reshape(n, LETTERS).astype(exact)


@lru_cache(maxsize=64)
def chunk_of(joined: str, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spelling, counts and squared norms of a chunk (its words, joined)."""
    spelled = letters([joined[i:i + length] for i in range(0, len(joined), length)])
    counts = counts_of(spelled)
    return spelled, counts, np.einsum("nd,nd->n", counts, counts)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of ``a`` and ``b`` differ by exactly one replaced letter or, where b's rows are one longer, by one
    inserted letter."""
    length = a.shape[1]
    if b.shape[1] == length:
        return (a != b).sum(1) == 1
    ahead = np.cumprod(a == b[:, :length], axis=1, dtype=np.int8).sum(1, dtype=np.int64)
    behind = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1, dtype=np.int8).sum(1, dtype=np.int64)
    return ahead + behind >= length


def near_in(left: tuple, right: tuple, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs of two chunks as places in them; ``same`` for a chunk with itself (each pair once)."""
    (a, ca, na), (b, cb, nb) = left, right
    if ca.dtype != cb.dtype:
        ca, cb = ca.astype(np.float64), cb.astype(np.float64)
    squared = na[:, None] + nb[None, :] - 2 * (ca @ cb.T)
    close = squared <= 2
    if same:
        close = np.triu(close, 1)
    i, j = np.nonzero(close)
    step = max(1, (1 << 22) // a.shape[1])  # letters compared at once
    kept = [one_edit(a[i[k:k + step]], b[j[k:k + step]]) for k in range(0, len(i), step)]
    kept = np.concatenate(kept) if kept else np.zeros(0, bool)
    return i[kept], j[kept]


def block_key(length: int, classes: tuple) -> str:
    return f"{length}:" + ",".join(map(str, classes))


def meets(length: int, classes: tuple) -> list[str]:
    """Keys of the blocks that a block is compared with, each two blocks once: itself, blocks of its length with one letter of
    another class (those of greater key), and blocks with one letter more."""
    found = [block_key(length, classes)]
    own = found[0]
    for up in range(CLASSES):
        more = [c + (k == up) for k, c in enumerate(classes)]
        found.append(block_key(length + 1, more))
        for down in range(CLASSES):
            if down != up and classes[down]:
                key = block_key(length, [c - (k == down) for k, c in enumerate(more)])
                if key > own:
                    found.append(key)
    return found


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): every ordered pair of ``words`` (word, n; distinct, of letters) that differ by exactly one
    inserted, deleted or replaced letter."""
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(maxsize=1 << 14)
        def met(length: int, classes: tuple) -> list[str]:
            return meets(length, classes)

        for batch in batches:
            spelled = batch.column(0).to_pylist()
            own = []
            for word in spelled:
                points = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.int64)
                of = np.bincount(np.where(points < 128, points - ord("a"), points - 0xC0 + 26) % CLASSES, minlength=CLASSES)
                own.append(met(len(word), tuple(of.tolist())))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([m[0] for m in own], pa.string()),
                                              pa.array(own, pa.list_(pa.string()))], ["word", "n", "block", "meets"])

    found = stored(words.select("word", "n").mapInArrow(keyed, "word string, n long, block string, meets array<string>"), "keyed")
    sizes = found.groupBy("block").agg(F.count(F.lit(1)).alias("size"))
    large = sizes.where(F.col("size") > CHUNK).select("block", F.ceil(F.col("size") / CHUNK).alias("chunks"))
    dealt = found.join(large, "block", "left").withColumn("chunk", F.coalesce(F.pmod(F.xxhash64("word"), F.col("chunks")), F.lit(0)))
    chunks = stored(dealt.groupBy("block", "chunk").agg(
        F.first("meets").alias("meets"), F.length(F.first("word")).alias("length"),
        F.sort_array(F.collect_list(F.struct("word", "n"))).alias("rows"))
        .select("block", "chunk", "meets", "length", F.array_join("rows.word", "").alias("words"), F.col("rows.n").alias("n")), "chunks")
    left = chunks.select(F.explode("meets").alias("block"), F.col("block").alias("own"), F.col("chunk").alias("a_chunk"),
                         F.col("length").alias("a_length"), F.col("words").alias("a"), F.col("n").alias("a_n"))
    pairs = (left.join(chunks.select("block", F.col("chunk").alias("b_chunk"), F.col("length").alias("b_length"), F.col("words").alias("b"), F.col("n").alias("b_n")), "block")
             .where((F.col("own") != F.col("block")) | (F.col("a_chunk") <= F.col("b_chunk")))
             .select("a", "a_length", "a_n", "b", "b_length", "b_n", ((F.col("own") == F.col("block")) & (F.col("a_chunk") == F.col("b_chunk"))).alias("same")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, near, near_n = [], [], []
            columns = [batch.column(k) for k in range(7)]
            for a, la, an, b, lb, bn, same in zip(*(c if pa.types.is_list(c.type) else c.to_pylist() for c in columns)):
                i, j = near_in(chunk_of(a, la), chunk_of(b, lb), same)
                if not len(i):
                    continue
                an, bn = (x.values.to_numpy(zero_copy_only=False) for x in (an, bn))
                x, y = [a[k * la:(k + 1) * la] for k in i.tolist()], [b[k * lb:(k + 1) * lb] for k in j.tolist()]
                word += x + y
                near += y + x
                near_n += bn[j].tolist() + an[i].tolist()
                if len(word) > HELD:
                    yield _pairs(word, near, near_n)
                    word, near, near_n = [], [], []
            yield _pairs(word, near, near_n)

    return pairs.mapInArrow(compare, "word string, near string, near_n long")


def _pairs(word: list, near: list, near_n: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(near, pa.string()), pa.array(near_n, pa.int64())], ["word", "near", "near_n"])


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """For every word of ``words`` (word, n): n, n_near (its near words), form and form_n, its most frequent near
    word (of equal ones the first in code-point order) if that occurs ``ratio`` times as often or more, else null, and root, the last
    word on the way from form to form (the word itself if it has none).  An empty table gives no rows."""
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    linked = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    enough = -F.col("best.less") >= ratio * F.col("n")
    judged = stored(words.join(linked, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.less")).alias("form_n")), "variants")
    # Every step goes twice as far; a form is ratio times as frequent, so the ways are short and have no circles
    ways = judged.where("form is not null").select("word", F.col("form").alias("root"), F.lit(True).alias("moved"))
    while True:
        ways = stored(ways, "ways")
        if not ways.where("moved").take(1):
            break
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ways = ways.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
    return judged.join(ways.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
