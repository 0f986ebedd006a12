"""What the corpus operators share: table access, text keys and distributed components."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelanes.session import stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; the path is only handed to Spark, so any store it reads will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: Column | str) -> Column:
    """64-bit key of a text.  With doc_id it names a row even where ids repeat; null and '' differ."""
    return F.xxhash64(text, F.isnull(text))


def utf8(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of an Arrow string column, nulls as empty, one value at a time."""
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected graph of long node ids.

    Alternates large-star and small-star steps: every step points nodes at the
    smallest neighbour, so the rounds grow with the logarithm of the longest path.
    Minima are combined before they are shuffled and each round is a written table.
    Returns (node, root), root the smallest node of the component, for all nodes with
    an edge; self-loops and nulls give no rows.
    """
    def step(links: DataFrame, larger: bool) -> DataFrame:
        # Every node with its smallest neighbour or itself, over the links as they point.
        least = links.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        if larger:
            moved = links.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                least.select("u", F.col("m").alias("v")))
        return moved.where("u <> v").groupBy("u", "v").agg(F.count(F.lit(1)).alias("n")).select("u", "v")

    def state(links: DataFrame) -> tuple:
        return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    links = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links")
    seen = state(links)
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        links = stored(step(step(both, True), False), "links")
        now = state(links)
        if now == seen:
            break
        seen = now
    root = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return root.unionByName(root.select(F.col("root").alias("node"), "root").distinct())


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n nodes over the links a-b (inside one task)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(before, label):
            return label


def word_counts(rows: DataFrame, group: str, words_of, word_type: str = "string", held: int = 200_000, by_word: bool = False) -> DataFrame:
    """(group, word, n) over all rows (group, text): n counts what ``words_of(text)`` yields for each text.

    Counts are added up in each task before they are shuffled; a task holds ``held`` words and passes
    its counts on when it has more.  With ``by_word`` all rows of a word come to one task, whatever their group, so a grouping
    by word needs no further shuffle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}

        def flush():
            keys = [(g, w) for g, words in sums.items() for w in words]
            n = [c for words in sums.values() for c in words.values()]
            sums.clear()
            return pa.RecordBatch.from_arrays([pa.array([g for g, _ in keys], kind), pa.array([w for _, w in keys]), pa.array(n, pa.int64())], [group, "word", "n"])

        for batch in batches:
            kind = batch.schema.field(0).type
            for g, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums.setdefault(g, Counter()).update(words_of(t or ""))
                if sum(map(len, sums.values())) > held:
                    yield flush()
        if sums:
            yield flush()

    schema = f"{group} {rows.schema[group].dataType.simpleString()}, word {word_type}, n long"
    parts = rows.select(group, "text").mapInArrow(count, schema)
    parts = parts.repartition("word") if by_word else parts
    return parts.groupBy(group, "word").agg(F.sum("n").alias("n"))
