"""Keyword search over a document table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import split_words
from corpusloom.operators.ranking import top_per_group

# --- fixed values -------------------------------------------------------------------------------
DEFAULT_TOPICS = (
    "Computer science",
    "Medicine",
    "Law",
    "Engineering",
    "Physics",
    "Biology",
    "Economics",
    "History",
    "Psychology",
    "Art",
)
DEFAULT_SEARCH_LIMIT = 500
HITS_PER_TOPIC = 1000
# ------------------------------------------------------------------------------------------------
TERM_SALTS = 16
BROADCAST_TERMS = 100_000


def keyword_search(
    docs: DataFrame,
    topics: DataFrame,
    doc_key: str = "doc_id",
    text: str = "text",
    topic: str = "topic",
    query: str = "query",
    limit: int = DEFAULT_SEARCH_LIMIT,
) -> DataFrame:
    """Documents that hold every term of a topic, ranked by how often the terms occur.

    Gives ``topic``, ``rank``, the document key and ``hits``; ties go to the lower key. The documents
    are scanned once: only the number of times a document holds each wanted term leaves the scan, no
    text does. Only documents with a topic's rarest term are looked at further, so a frequent word
    pairs a topic with documents only when all of the topic's words are that frequent. Terms and topics
    are counted and broadcast up to ``BROADCAST_TERMS`` terms. Beyond that the rows of a term are split
    by a salt, and documents are paired with topics by key and term alone, before their counts are read.
    """
    salt = F.pmod(F.xxhash64(doc_key), F.lit(TERM_SALTS)).cast("int").alias("_salt")
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(TERM_SALTS - 1))).alias("_salt")

    wanted = topics.select(topic, F.array_distinct(split_words(F.lower(F.col(query)))).alias("_terms"))
    terms = wanted.select(topic, "_terms", F.explode("_terms").alias("_term"))
    few = terms.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS
    words = docs.select(doc_key, F.explode(split_words(F.lower(F.col(text)))).alias("_term"))
    if few:
        words = words.join(F.broadcast(terms.select("_term").distinct()), "_term")
    else:
        words = words.withColumn("_salt", salt).join(terms.select("_term").distinct().select("_term", every_salt), ["_term", "_salt"])
    # One row per document with the terms it holds: as many as are wanted, however long its text.
    counted = words.groupBy(doc_key, "_term").agg(F.count("*").alias("_n"))
    frequency = counted.groupBy("_term").agg(F.count("*").alias("_docs"))
    rarest = (
        terms.join(F.broadcast(frequency) if few else frequency, "_term", "left")
        .groupBy(topic, "_terms")
        .agg(F.min(F.struct(F.coalesce("_docs", F.lit(0)).alias("_docs"), "_term")).alias("_rarest"))
        .where(F.col("_rarest._docs") > 0)
        .select(topic, "_terms", F.col("_rarest._term").alias("_term"))
    )
    held = counted.groupBy(doc_key).agg(F.map_from_entries(F.collect_list(F.struct("_term", "_n"))).alias("_held"))
    if few:
        by_term = F.broadcast(rarest.groupBy("_term").agg(F.collect_list(F.struct(topic, "_terms")).alias("_topics")))
        of_term = held.select(doc_key, "_held", F.explode(F.map_keys("_held")).alias("_term")).join(by_term, "_term")
        candidates = of_term.select(doc_key, "_held", F.explode("_topics").alias("_t")).select(doc_key, "_held", "_t.*")
    else:
        paired = counted.select(doc_key, salt, "_term").join(rarest.select(topic, "_terms", "_term", every_salt), ["_term", "_salt"])
        # A document without key is one of its own kind here too.
        candidates = paired.withColumnRenamed(doc_key, "_key").join(held, F.col("_key").eqNullSafe(F.col(doc_key)))
    matches = candidates.where(F.forall("_terms", lambda t: F.map_contains_key("_held", t))).select(
        topic, doc_key, F.aggregate("_terms", F.lit(0).cast("bigint"), lambda s, t: s + F.col("_held")[t]).alias("hits")
    )
    ranked = top_per_group(matches, [topic], [F.desc("hits"), F.asc(doc_key)], limit, rank="rank")
    return ranked.select(topic, "rank", doc_key, "hits")


def hits_per_topic(topics: DataFrame, hits: DataFrame, topic: str = "topic") -> DataFrame:
    """Number of hits of every topic; a topic without any is listed with 0."""
    counted = hits.groupBy(topic).agg(F.count("*").alias("hits"))
    return topics.select(topic).distinct().join(counted, topic, "left").select(topic, F.coalesce("hits", F.lit(0)).alias("hits"))
