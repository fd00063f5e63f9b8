"""The operators of this subpackage as registered queries, with SQL where it can give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm import (
    comparison,
    decontaminate,
    line_dedup,
    merkle_manifest,
    minhash_dedup,
    packing,
    periodic_runs,
    quality_classifier,
    quality_rules,
    simhash_dedup,
    substring_dedup,
    token_counts,
    token_output,
    toxicity,
)
from salesloom.llm.common import ID, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return register


@query("op1_decontamination")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: whether it holds a passage of the benchmark, of which items, and confirmed seed hits."""
    found = decontaminate.contamination(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
    return found.select(F.col(ID).alias("doc_id"), "contaminated", "items", "hits")


@query("op2_token_counts")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: unigram tokens of the whole text, and the score of the best segmentation."""
    return token_counts.token_counts(read_table(spark, folder, "documents"))


@query("op3_suffix_array_dedup", comparison.SUBSTRINGS)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: its bytes, those that an earlier document has, their spans, the hash of the rest."""
    return substring_dedup.remove_repeats(read_table(spark, folder, "documents")).drop("kept")


@query("op4_quality_classifier")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: whether it is held out, its quality score, and the prediction."""
    return quality_classifier.quality_scores(
        read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    )


@query("op5_token_output")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files read back: ids before it, number of ids, their checksum."""
    return token_output.token_round_trip(read_table(spark, folder, "documents"))


@query("op6_best_fit_packing")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Per piece of a document: its bin and place."""
    return packing.pack_documents(read_table(spark, folder, "documents"))


@query("op7_minhash_dedup", comparison.MINHASH)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: size of its shingle set, its group, whether it stays."""
    return minhash_dedup.near_duplicates(read_table(spark, folder, "documents"))


@query("op8_line_dedup")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: lines with a word, how many of them go, and their places."""
    found = line_dedup.repeated_lines(read_table(spark, folder, "documents"))
    return found.select(
        F.col(ID).alias("doc_id"),
        F.col("lines").alias("n_lines"),
        F.size("removed").cast("long").alias("n_removed"),
        "removed",
    )


@query("op9_toxicity")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: the probability of each category, and whether it is toxic."""
    return toxicity.toxicity(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


@query("op10_quality_rules", comparison.QUALITY_RULES)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, base failure and verdict of every document."""
    found = quality_rules.judged(read_table(spark, folder, "documents"))
    return found.select(
        F.col(ID).alias("doc_id"),
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"),
        "base_failed",
        "kept",
        "host_failed",
    )


@query("op11_merkle_manifest", comparison.MERKLE)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: its leaf, the roots above it, its proof, and whether the document with changed case passes it."""
    docs = read_table(spark, folder, "documents")
    return merkle_manifest.verified(docs, merkle_manifest.tampered_leaf(docs))


@query("op12_periodic_runs")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, of which one in ten is made to repeat itself: its periodic runs and what is left without them."""
    docs = periodic_runs.with_planted_runs(read_table(spark, folder, "documents"))
    return periodic_runs.periodic_runs(docs).drop("runs")


@query("op13_simhash_dedup")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: its fingerprint and its group of near duplicates."""
    return simhash_dedup.near_duplicates(read_table(spark, folder, "documents"))
