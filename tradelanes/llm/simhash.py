"""SimHash near-duplicates over a Gray-order hierarchical index.

Fingerprints that differ in at most k bits agree on at least one of k+1 blocks of
bits.  Each block is an upper node: a mask and the pattern its members share under
it.  Fingerprints are dealt to the nodes they belong to; a node with too many members
is factored again over its remaining bits, which keeps every pair (the same argument
holds for the rest of the bits) and bounds what one node can hold.  Inside a node the
members are sorted by Gray rank, so neighbours share bits; a tree factors the bits that
groups of neighbours share into their parents, and a search adds up differences from the
top and drops whole groups that already differ too much.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelanes.llm.common import components, roots, text_key
from tradelanes.session import stored

BITS = 64
NODE = 4096  # most members a node keeps before its remaining bits are factored
FANOUT = 16  # neighbours in Gray order under one parent
_BLOCK = 1 << 16  # shingle hashes held at once
SEED = 42


def fingerprint(text: str | None, shingle: int = 3, seed: int = SEED) -> int:
    """64-bit SimHash of a text: ASCII letters lowered, words between ASCII white space."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    data = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) < shingle:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1:]
    counts = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), _BLOCK):
        spans = zip(starts[at: at + _BLOCK].tolist(), ends[at: at + _BLOCK].tolist())
        hashes = np.array([digest(data[s:e], seed) for s, e in spans], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits((2 * counts > len(starts)), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint_column(text: Column | str, shingle: int = 3, seed: int = SEED) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle, seed) for t in texts], dtype="int64")

    return of(text)


def gray_rank(code: Column) -> Column:
    """Position of a code in the Gray sequence (as the bits of a long)."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _blocks(mask: int, parts: int) -> list[int]:
    """The mask widened by each of ``parts`` blocks of its free bits (as unsigned numbers).  None with fewer free
    bits than blocks: codes could then differ in every block; such a node has few members anyway."""
    free = [i for i in range(BITS - 1, -1, -1) if not mask >> i & 1]
    if len(free) < parts:
        return []
    cut = [round(k * len(free) / parts) for k in range(parts + 1)]
    return [mask | sum(1 << i for i in free[s:e]) for s, e in zip(cut, cut[1:])]


class GrayTree:
    """Hierarchy over codes in Gray order: a parent holds the bits its children share,
    a child only the rest, so differences along a path add up without counting a bit twice."""

    def __init__(self, codes: np.ndarray, fanout: int = FANOUT):
        full = np.uint64(2**64 - 1)
        masks, patterns = [np.full(len(codes), full)], [codes]
        while len(patterns[-1]) > fanout:
            at = np.arange(0, len(patterns[-1]), fanout)
            first = patterns[-1][at]
            spread = np.repeat(first, np.diff(np.append(at, len(patterns[-1]))))
            shared = np.bitwise_and.reduceat(masks[-1], at) & ~np.bitwise_or.reduceat(patterns[-1] ^ spread, at)
            masks.append(shared)
            patterns.append(first & shared)
        self.fanout, self.patterns = fanout, patterns
        self.own = [m & ~np.repeat(up, fanout)[: len(m)] for m, up in zip(masks, masks[1:])] + masks[-1:]

    def search(self, queries: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(query position, code position) of all pairs within ``most`` differing bits."""
        level = len(self.patterns) - 1
        width = len(self.patterns[level])
        q = np.repeat(np.arange(len(queries)), width)
        node = np.tile(np.arange(width), len(queries))
        far = np.zeros(len(q), np.int64)
        while True:
            far = far + np.bitwise_count((queries[q] ^ self.patterns[level][node]) & self.own[level][node])
            near = far <= most
            q, node, far = q[near], node[near], far[near]
            if level == 0:
                return q, node
            level -= 1
            q, far = np.repeat(q, self.fanout), np.repeat(far, self.fanout)
            node = (node[:, None] * self.fanout + np.arange(self.fanout)).ravel()
            inside = node < len(self.patterns[level])
            q, node, far = q[inside], node[inside], far[inside]


def _close_pairs(codes: np.ndarray, run: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions within one run whose codes differ in at most ``most`` bits."""
    starts = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
    lengths = np.diff(np.append(starts, len(run)))
    left, right = [], []
    small = np.repeat(lengths <= 2 * FANOUT, lengths)
    for step in range(1, min(2 * FANOUT, len(run))):  # runs too short for a tree
        same = np.flatnonzero((run[step:] == run[:-step]) & small[step:])
        if not len(same):
            break
        near = same[np.bitwise_count(codes[same] ^ codes[same + step]) <= most]
        left.append(near)
        right.append(near + step)
    for s, n in zip(starts[lengths > 2 * FANOUT].tolist(), lengths[lengths > 2 * FANOUT].tolist()):
        tree = GrayTree(codes[s: s + n])
        for at in range(0, n, 256):
            q, c = tree.search(codes[s + at: s + min(n, at + 256)], most)
            keep = q + at < c
            left.append(q[keep] + at + s)
            right.append(c[keep] + s)
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return join(left), join(right)


def _links(most: int):
    """Rows sorted by node and Gray rank -> links (a, b) that span each group of close codes."""
    def run_of(mask: np.ndarray, pattern: np.ndarray) -> np.ndarray:
        change = (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])
        return np.concatenate(([0], np.cumsum(change))) if len(mask) else np.zeros(0, np.int64)

    def spanning(mask, pattern, code) -> pa.RecordBatch:
        unsigned = code.view(np.uint64)
        i, j = _close_pairs(unsigned, run_of(mask, pattern), most)
        top = roots(len(code), i, j)
        moved = np.flatnonzero(top != np.arange(len(code)))
        return pa.RecordBatch.from_arrays([pa.array(code[moved]), pa.array(code[top[moved]])], ["a", "b"])

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            held = [np.concatenate((h, c.to_numpy(zero_copy_only=False))) for h, c in zip(held, batch.columns)]
            run = run_of(held[0], held[1])
            if len(run) and run[-1]:  # the last node may go on in the next batch
                last = int(np.searchsorted(run, run[-1]))
                yield spanning(*(h[:last] for h in held))
                held = [h[last:] for h in held]
        yield spanning(*held)

    return links


def close_links(codes: DataFrame, column: str = "fp", most: int = 2, node_size: int = NODE) -> DataFrame:
    """Links (a, b) that connect the distinct codes of ``column`` exactly as "differ in at most
    ``most`` bits" does: no row for each pair, but a spanning set for each node of the index."""
    spark = codes.sparkSession
    tops = _blocks(0, most + 1)
    rows = codes.select(F.col(column).alias("fp"))
    under = lambda masks: F.explode(F.array(*[F.lit(_signed(m)) for m in masks]))
    level, dealt, found = tops, rows.select("fp", under(tops).alias("mask")), None
    while True:
        dealt = dealt.withColumn("pattern", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = dealt.groupBy("mask", "pattern").agg(F.count(F.lit(1)).alias("n"))
        large = stored(sizes.where(F.col("n") > node_size).select("mask", "pattern"), "large_nodes")
        split = [(m, _blocks(m, most + 1)) for m in level]
        any_large = not large.isEmpty() and any(kids for _, kids in split)
        leaves = dealt.join(large, ["mask", "pattern"], "left_anti") if any_large else dealt
        close = (leaves.repartition("mask", "pattern")
                 .sortWithinPartitions("mask", "pattern", gray_rank(F.col("fp")).bitwiseXOR(F.lit(-(1 << 63))))
                 .select("mask", "pattern", "fp").mapInArrow(_links(most), "a long, b long"))
        if any_large:
            close = stored(close, "close_links")
        found = close if found is None else found.unionByName(close)
        if not any_large:
            return found
        # (most + 1) ** depth rows at most, from the masks alone
        children = spark.createDataFrame([(_signed(m), _signed(k)) for m, kids in split for k in kids], "mask long, child long")
        dealt = stored(dealt.join(large, ["mask", "pattern"], "left_semi").join(F.broadcast(children), "mask")
                       .select("fp", F.col("child").alias("mask")), "dealt")
        level = [k for _, kids in split for k in kids]


def near_duplicates(docs: DataFrame, shingle: int = 3, most: int = 2, id_col: str = "doc_id",
                    text_col: str = "text", node_size: int = NODE) -> DataFrame:
    """SimHash groups of documents.

    Returns one row per input row: doc_id, text_key (see ``text_key``), fp (long),
    fingerprint (16 hex digits), group (smallest fingerprint reachable) and component_id
    (smallest id of the group).  Null and wordless texts have fingerprint zero, linked like any
    other.  Rows with a null id take part; a group of such rows only has a null component_id.
    Repeated rows come back as often as they came; other columns are not read.
    """
    prints = stored(docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"),
                                fingerprint_column(F.col(text_col), shingle).alias("fp")), "fingerprints")
    codes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "codes")
    linked = components(close_links(codes, "fp", most, node_size))
    grouped = (codes.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
               .select("fp", "first", F.coalesce("root", "fp").alias("group")))
    least = grouped.groupBy("group").agg(F.min("first").alias("component_id"))
    of = grouped.join(least, "group").select("fp", "group", "component_id")
    return (prints.join(of, "fp")
            .select("doc_id", "text_key", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                    "group", "component_id"))


def keep_one(docs: DataFrame, shingle: int = 3, most: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each SimHash group: the one with the smallest id (null ids last; of rows that
    repeat id and text, one).  All columns stay, whatever their names."""
    near = near_duplicates(docs, shingle, most, id_col, text_col)
    # Of each group the rows with its smallest id; where an id repeats, the smallest text key.
    chosen = (near.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
              .groupBy("group").agg(F.min(F.struct("doc_id", "text_key")).alias("one")))
    chosen = chosen.select(F.col("one.doc_id").alias("__id"), F.col("one.text_key").alias("__key"))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("__id"), text_key(F.col(text_col)).alias("__key"))
    kept = rows.alias("r").join(chosen.alias("c"), F.col("r.__key").eqNullSafe(F.col("c.__key"))
                                & F.col("r.__id").eqNullSafe(F.col("c.__id")), "left_semi")
    return kept.dropDuplicates(["__id", "__key"]).select("row.*")
