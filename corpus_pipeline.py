"""Documents to token ids: language ID, line dedup, near-dedup, decontamination, byte-level BPE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.bpe import encode_documents
from corpusloom.llm.language import in_known_language
from corpusloom.llm.leaks import without_leaks
from corpusloom.llm.lines import without_repeated_lines
from corpusloom.llm.near import one_per_group
from corpusloom.llm.queries import public_ranks
from corpusloom.llm.store import stored, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the labelled languages."""
    return in_known_language(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line equals or resembles."""
    cut = without_repeated_lines(docs)
    return cut.withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns) if "n_chars" in docs.columns else cut


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids, and whether they decode to the text."""
    encoded = encode_documents(docs.select("doc_id", "lang", "source", "text"), *public_ranks())
    exact = F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return encoded.select("doc_id", "lang", "source", "ids", F.size("ids").cast("bigint").alias("n_tokens"), exact.alias("exact"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

# Longest matches in learned texts, similarity groups and ranked merges are not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
