"""Corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet and reads again as the
next stage's documents.  All stages but the last return the columns of their input, whatever these are, besides
doc_id, text and source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelanes.llm import bpe, contamination, lines, quality, simhash
from tradelanes.llm.common import table
from tradelanes.llm.queries import MIN_SITES, vocabulary_path
from tradelanes.session import stored


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a scorer trained on this input's weak labels takes for good; texts without words go."""
    return quality.keep_good(docs, quality.train(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without cross-site boilerplate lines; n_chars follows the text."""
    out = lines.dedup_lines(docs, min_sites=MIN_SITES)
    changed = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("clean").cast(docs.schema["n_chars"].dataType)
    return out.select(*(changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return simhash.keep_one(docs, shingle=3, most=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return contamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the SHA-256 of the text decoded from the ids."""
    out = bpe.encode(spark, docs, vocabulary_path())
    return out.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_filter),
    ("line dedup", line_dedup),
    ("simhash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", decontamination),
    ("bpe", tokens),
]

#: The classifier, SimHash and BPE stages are beyond SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
