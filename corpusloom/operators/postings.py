"""A stored inverted index for keyword search: postings by term and block of documents."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusloom.functions.text import split_words
from corpusloom.operators.ranking import top_per_group
from corpusloom.operators.search import DEFAULT_SEARCH_LIMIT

BLOCK_DOCS = 512
BUCKETS = 16
SLICE_BLOCKS = 256
SEED_BLOCKS = 8
MOST_TERMS = 1000  # that are named to the scan


def build_postings(docs: DataFrame, doc_key: str = "doc_id", text: str = "text", block_docs: int = BLOCK_DOCS, buckets: int = BUCKETS) -> DataFrame:
    """``term, block, postings, n_docs, most, bucket``: which documents of a block hold a term.

    Documents are dealt into blocks of about ``block_docs`` by a hash of their key, the same blocks
    for every term. A row has the ``postings`` (key and number of occurrences) of one term in one
    block in order of key, how many there are and the ``most`` occurrences in one of them. The
    texts are shuffled once, to their block, and counted there a block at a time. So a row is bounded
    by its block, however frequent the term.

    Defined results: null texts have no terms; rows of one key count as one document; rows without
    key take no part.
    """
    keyed = docs.where(F.col(doc_key).isNotNull()).select(doc_key, F.col(text).alias("_text"))
    blocks = max(1, -(-keyed.count() // block_docs))
    block = F.pmod(F.xxhash64(doc_key), F.lit(blocks)).alias("block")
    # Sorted as plain texts, and split into words only then.
    dealt = keyed.select(doc_key, block, "_text").repartition("block").sortWithinPartitions("block")
    words = dealt.select("block", doc_key, split_words(F.lower("_text")).alias("_words"))
    entry = T.StructType([keyed.schema[doc_key], T.StructField("n", T.LongType())])
    schema = T.StructType([
        T.StructField("block", T.LongType()),
        T.StructField("term", T.StringType()),
        T.StructField("postings", T.ArrayType(entry)),
        T.StructField("n_docs", T.LongType()),
        T.StructField("most", T.LongType()),
    ])
    nothing = to_arrow_schema(schema).empty_table()

    def count(table: pa.Table) -> pa.Table:
        lists = table["_words"].combine_chunks()
        words = lists.flatten().dictionary_encode()
        if not len(words):
            return nothing
        keys = table[doc_key].combine_chunks().dictionary_encode()
        order = pc.sort_indices(keys.dictionary).to_numpy()
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        document = place[keys.indices.to_numpy()][pc.list_parent_indices(lists).to_numpy()]
        pairs, n = np.unique(words.indices.to_numpy().astype(np.int64) * len(order) + document, return_counts=True)
        term, document = np.divmod(pairs, len(order))
        starts = np.flatnonzero(np.diff(term, prepend=-1))
        entries = [keys.dictionary.take(pa.array(order[document])), pa.array(n)]
        offsets = pa.array(np.append(starts, len(term)).astype(np.int32))
        columns = [
            pa.array(np.full(len(starts), table["block"][0].as_py())),
            words.dictionary.take(pa.array(term[starts])),
            pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(entries, names=[doc_key, "n"])),
            pa.array(np.diff(offsets.to_numpy()).astype(np.int64)),
            pa.array(np.maximum.reduceat(n, starts)),
        ]
        return pa.table(columns, names=schema.names).cast(nothing.schema)

    rows = words.groupBy("block").applyInArrow(count, schema)
    return rows.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int"))


def write_postings(postings: DataFrame, path: str) -> None:
    """Postings as parquet, a folder per bucket of terms and the rows of a file in order of term.

    A file holds the terms of a bucket for a slice of the blocks, so the postings of a frequent term are
    spread over files, and its row groups are found by their bounds. Placed by value, not by range, as a
    range would have every text counted once more for its bounds.
    """
    slices = F.floor(F.col("block") / SLICE_BLOCKS)
    placed = postings.repartition("bucket", slices).sortWithinPartitions("bucket", "term", "block")
    placed.write.mode("overwrite").partitionBy("bucket").parquet(path)


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def document_frequencies(postings: DataFrame) -> DataFrame:
    """``term, docs``: in how many documents each term occurs; no posting is read for it."""
    return postings.groupBy("term").agg(F.sum("n_docs").alias("docs"))


def search_postings(
    postings: DataFrame,
    topics: DataFrame,
    doc_key: str = "doc_id",
    topic: str = "topic",
    query: str = "query",
    limit: int = DEFAULT_SEARCH_LIMIT,
    buckets: int = BUCKETS,
    seeds: int = SEED_BLOCKS,
) -> DataFrame:
    """Documents that hold every term of a topic, ranked by how often the terms occur: ``topic, rank,
    doc_key, hits``, ties to the lower key. The same result as ``keyword_search`` over the texts.

    First only the numbers of the wanted terms' blocks are read: a block that lacks one of a
    topic's terms has no match, and the sum of its terms' ``most`` bounds the hits of any document in
    it. The blocks of highest bound are searched first; the hits of the last place they fill are a
    floor, and of the other blocks only those whose bound reaches it have their postings read.
    ``buckets`` is the number the index was built with.
    """
    terms = F.array_distinct(split_words(F.lower(F.col(query))))
    asked = topics.select(F.col(topic).alias("topic"), F.size(terms).alias("needed"), F.explode(terms).alias("term"))
    asked = asked.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int"))
    names = asked.select("bucket", "term").distinct().limit(MOST_TERMS + 1).collect()
    if len(names) <= MOST_TERMS:
        # A short list of terms tells the scan which folders and row groups to read.
        postings = postings.where(F.col("bucket").isin(sorted({r.bucket for r in names})) & F.col("term").isin(sorted({r.term for r in names})))

    known = postings.select("bucket", "term", "block", "n_docs", "most").join(asked, ["bucket", "term"])
    blocks = known.groupBy("topic", "needed", "block").agg(F.count("*").alias("held"), F.sum("most").alias("bound"))
    blocks = blocks.where("held = needed").select("topic", "needed", "block", "bound")

    def matches(chosen: DataFrame) -> DataFrame:
        rows = postings.select("bucket", "term", "block", "postings").join(asked, ["bucket", "term"])
        rows = rows.join(chosen.select("topic", "block"), ["topic", "block"]).select("topic", "needed", F.explode("postings").alias("p"))
        per_doc = rows.groupBy("topic", "needed", F.col(f"p.{doc_key}").alias(doc_key)).agg(F.count("*").alias("held"), F.sum("p.n").alias("hits"))
        return per_doc.where("held = needed").select("topic", doc_key, "hits")

    order = [F.desc("hits"), F.asc(doc_key)]
    first = top_per_group(blocks, ["topic"], [F.desc("bound"), F.asc("block")], seeds)
    found = top_per_group(matches(first), ["topic"], order, limit, rank="rank")
    floor = found.where(F.col("rank") == limit).select("topic", F.col("hits").alias("floor"))
    rest = blocks.join(first, ["topic", "block"], "left_anti").join(floor, "topic", "left").where("floor is null or bound >= floor")
    both = found.drop("rank").unionByName(matches(rest))
    ranked = top_per_group(both, ["topic"], order, limit, rank="rank")
    return ranked.select(F.col("topic").alias(topic), "rank", doc_key, "hits")
