"""Queries of the corpus operators over the driver's tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelanes.llm import bpe, contamination, language, lines, matching, merkle, quality, rules, secrets, simhash, spelling, toxicity, urls
from tradelanes.llm.common import table
from tradelanes.llm.oracle import op10_sql, op11_sql, op12_sql, op6_sql


MIN_SITES = 5  # sites from which a line is boilerplate


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return simhash.near_duplicates(docs, shingle=3, most=2).select("doc_id", "fingerprint", "component_id")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"), rate=0.05)


def op3_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return matching.near_report(docs, matching.Lexicons(matching.band(docs)))


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(spark, table(spark, sf_dir, "documents"), vocabulary_path(), digests=True)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(table(spark, sf_dir, "documents"), min_sites=MIN_SITES)
    return out.select("row.doc_id", "n_lines", "n_removed", F.sha2("clean", 256).alias("clean_sha256"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_items", "covered", "consistent")


def fold(folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def held_out(folds: int, rest: int) -> Column:
    return F.coalesce(fold(folds) == rest, F.lit(False)).alias("held_out")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.where(fold(5) != 0).select("lang", "text"))
    return language.predict(docs, model).select("doc_id", held_out(5, 0), "lang_pred", "score")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(fold(3) != 1)
    model = toxicity.train(docs, labels)
    return toxicity.score(docs, model, threshold=0.7).select("doc_id", held_out(3, 1), "score", "predicted")


#: The rules that op10 is asked to apply.
ALLOW = ("com/", "www.example.com/en/")
BLOCK = ("example.com/en/", "net/es/", "net/fr/")


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(table(spark, sf_dir, "pages"), urls.as_rules(spark, ALLOW, BLOCK))
    return judged.select("page_id", "host", "path", "rule", "verdict")


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth row by crc32 is edited: its text loses its capitals."""
    edited = F.when(fold(5) == 0, F.translate("text", UPPER, LOWER))
    proofs = merkle.build(table(spark, sf_dir, "documents"), edited).proofs()
    return proofs.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.vocabulary(table(spark, sf_dir, "documents"), drop_one_in=31, least_chars=7, least=2)
    return spelling.variants(words, ratio=10).select("word", "form", "root", "n", "n_near", "form_n")


def op13_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_secrets": op2_secrets,
    "op3_imatch": op3_imatch,
    "op4_bpe": op4_bpe,
    "op5_quality": op5_quality,
    "op6_line_dedup": op6_line_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_language": op8_language,
    "op9_toxicity": op9_toxicity,
    "op10_urls": op10_urls,
    "op11_merkle": op11_merkle,
    "op12_spelling": op12_spelling,
    "op13_rules": op13_rules,
}

ORACLE: dict[str, str] = {
    "op6_line_dedup": op6_sql(min_sites=MIN_SITES),
    "op10_urls": op10_sql(ALLOW, BLOCK, urls.LINK, urls.DAMPING, 150, urls.THRESHOLD),  # rounds far beyond where the scores stand
    "op11_merkle": op11_sql(merkle.FIELDS),
    "op12_spelling": op12_sql(drop_one_in=31, least_chars=7, least=2, ratio=10),
}
