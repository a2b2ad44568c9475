"""Embeddings and nearest-neighbour search."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog import sql
from corpusloom.catalog.tables import documents, table
from corpusloom.functions.vectors import cosine, hashed_counts, model_embedder, unit_length
from corpusloom.operators.cells import assign_cells, fit_cells, nearest_in_cells
from corpusloom.operators.nearest import nearest, nearest_by_shard, order_by_certainty, rank_matches
from corpusloom.operators.pruned import cell_radii, nearest_pruned, place_in_cells
from corpusloom.operators.quantised import Quantiser, encode, fit_codewords, mean_centres, nearest_coded
from corpusloom.session import work_folder
from corpusloom.sinks.index import write_index

PARTS, CODEWORDS = 32, 64
PROBES, SHORT_LIST = 9, 64  # recall of the neighbours of at least 0.9
# The vectors lie in a few small files.
KEYS = dict(asked_keys=["qid"], item_keys=["vec_id"], item_vector="embedding", deal=True)


def _asked(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vector"))


def _items(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding", (F.col("vec_id") % 5).cast("int").alias("shard"))


def _scored(matches, *extra):
    return matches.select(
        "qid",
        "vec_id",
        *extra,
        F.col("match_rank").cast("bigint").alias("match_rank"),
        F.round("distance", 6).alias("distance"),
        F.round("certainty", 6).alias("certainty"),
    )


def hashed_embedding(spark, sf_dir):
    """Non-zero coordinates of every document's unit-length embedding."""
    docs = documents(spark, sf_dir)
    counts = docs.select("doc_id", hashed_counts()(F.col("text")).alias("vector"))
    weights = counts.select("doc_id", F.posexplode(unit_length(F.col("vector"))).alias("bucket", "weight")).where("weight > 0")
    return weights.select("doc_id", F.col("bucket").cast("bigint").alias("bucket"), F.round("weight", 6).alias("weight"))


def _letter_model():
    """Stand-in for a user's model: counts of four letters."""
    return lambda texts: [[text.count(letter) for letter in "aeio"] for text in texts]


def model_embedding(spark, sf_dir):
    vectors = documents(spark, sf_dir).select("doc_id", model_embedder(_letter_model)(F.col("text")).alias("v"))
    return vectors.select("doc_id", *[F.col("v")[i].cast("bigint").alias(name) for i, name in enumerate("aeio")])


def cosine_of_pairs(spark, sf_dir):
    """Cosine of every embedding with its own reverse."""
    rows = table(spark, sf_dir, "embeddings")
    return rows.select("vec_id", F.round(cosine(F.col("embedding"), F.reverse("embedding")), 6).alias("score"))


def _others(matches, k):
    """Neighbours other than the vector itself: one more than k was asked for."""
    return rank_matches(matches.where("qid <> vec_id").select("qid", "vec_id", "score"), k, ["qid"], ["vec_id"])


def knn_top1(spark, sf_dir):
    return _scored(_others(nearest(_asked(spark, sf_dir), _items(spark, sf_dir), 2, **KEYS), 1))


def knn_topk(spark, sf_dir):
    return _scored(_others(nearest(_asked(spark, sf_dir), _items(spark, sf_dir), 11, **KEYS), 10))


def knn_topk_grid(spark, sf_dir):
    """The same search laid out as a grid, the way for question sets too large to broadcast."""
    matches = nearest(_asked(spark, sf_dir), _items(spark, sf_dir), 11, broadcast_bytes=0, cell_bytes=64 << 10, **KEYS)
    return _scored(_others(matches, 10))


def sharded_topk_merge(spark, sf_dir):
    matches = nearest_by_shard(_asked(spark, sf_dir), _items(spark, sf_dir), 1, 3, **KEYS)
    return order_by_certainty(_scored(matches, F.col("shard").cast("bigint").alias("shard")), "qid", "vec_id")


def coded_index(spark, sf_dir):
    """Embeddings by cell with their codes, as stored, and the quantiser. The centres are the labels'
    means, the codewords parts of given vectors, so SQL can tell them too."""
    rows = table(spark, sf_dir, "embeddings").withColumnRenamed("embedding", "vector")
    quantiser = Quantiser(mean_centres(rows, "label"), fit_codewords(rows, "vec_id", PARTS, CODEWORDS, rounds=0))
    path = work_folder(spark, "cells")
    write_index(encode(rows.select("vec_id", "vector"), quantiser), path, compact=True, by="cell")
    return spark.read.parquet(path).where("cell is not null"), quantiser


def knn_ivf(spark, sf_dir):
    """Approximate search: codes of the nearest cells, then a short list of vectors."""
    index, quantiser = coded_index(spark, sf_dir)
    found = nearest_coded(_asked(spark, sf_dir), index, quantiser, 6, probes=PROBES, short_list=SHORT_LIST, asked_keys=["qid"], item_keys=["vec_id"])
    return _scored(_others(found, 5))


def knn_pruned(spark, sf_dir):
    """Exact search of stored cells, of which those out of reach are not read."""
    items = _items(spark, sf_dir).withColumnRenamed("embedding", "vector")
    centres = mean_centres(table(spark, sf_dir, "embeddings"), "label", "embedding")
    path = work_folder(spark, "cells")
    write_index(place_in_cells(items.select("vec_id", "vector"), centres), path, compact=True, by="cell")
    placed = spark.read.parquet(path)
    found = nearest_pruned(_asked(spark, sf_dir), placed, centres, cell_radii(placed, centres), 11, asked_keys=["qid"], item_keys=["vec_id"], deal=True)
    return _scored(_others(found, 10))


def knn_ivf_all_cells(spark, sf_dir):
    """The same with every cell probed, which is exact."""
    items = _items(spark, sf_dir)
    model = fit_cells(items, 16, vector="embedding")
    placed = assign_cells(items, model, vector="embedding").withColumnRenamed("embedding", "vector")
    return _scored(nearest_in_cells(_asked(spark, sf_dir), placed, model, 5, 16, asked_keys=["qid"], item_keys=["vec_id"], deal=True))


QUERIES = {
    "hashed_embedding": hashed_embedding,
    "model_embedding": model_embedding,
    "cosine_of_pairs": cosine_of_pairs,
    "knn_top1": knn_top1,
    "knn_topk": knn_topk,
    "knn_topk_grid": knn_topk_grid,
    "sharded_topk_merge": sharded_topk_merge,
    "knn_ivf": knn_ivf,
    "knn_pruned": knn_pruned,
    "knn_ivf_all_cells": knn_ivf_all_cells,
}

_WIDTH = 64 // PARTS
_SCORES = """
v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, vec_id % 5 AS shard FROM embeddings),
pairs AS (
  SELECT q.vec_id AS qid, i.vec_id, i.shard, round(list_cosine_similarity(q.e, i.e), 12) AS score FROM v q CROSS JOIN v i)"""


def _top(source: str, k: int, extra: str = "") -> str:
    return f"""
        SELECT qid, vec_id, {extra} row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id) AS match_rank,
          round(1 - score, 6) AS distance, round(1 - (1 - score) / 2, 6) AS certainty FROM {source} QUALIFY match_rank <= {k}"""


ORACLE = {
    "hashed_embedding": f"""
        WITH {sql.counts('held', 'documents', 'doc_id', 'text')}
        SELECT doc_id, b AS bucket, round(c / sqrt(n::DOUBLE), 6) AS weight FROM held JOIN held_norm USING (doc_id)""",
    "model_embedding": "SELECT doc_id, "
    + ", ".join(f"(length(text) - length(replace(text, '{letter}', '')))::BIGINT AS {letter}" for letter in "aeio")
    + " FROM documents",
    "cosine_of_pairs": """
        SELECT vec_id, round(list_cosine_similarity(e, list_reverse(e)), 6) AS score
        FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)""",
    "knn_top1": f"WITH {_SCORES}" + _top("(SELECT * FROM pairs WHERE qid <> vec_id)", 1),
    "knn_topk": f"WITH {_SCORES}" + _top("(SELECT * FROM pairs WHERE qid <> vec_id)", 10),
    "knn_topk_grid": f"WITH {_SCORES}" + _top("(SELECT * FROM pairs WHERE qid <> vec_id)", 10),
    "knn_pruned": f"WITH {_SCORES}" + _top("(SELECT * FROM pairs WHERE qid <> vec_id)", 10),
    "sharded_topk_merge": f"""
        WITH {_SCORES}, by_shard AS (
          SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY qid, shard ORDER BY score DESC, vec_id) <= 1)"""
    + _top("by_shard", 3, "shard,"),
    "knn_ivf_all_cells": f"WITH {_SCORES}" + _top("pairs", 5),
    "knn_ivf": f"""
        WITH {_SCORES},
        u AS (SELECT vec_id, label, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS u FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)),
        xs AS (SELECT vec_id, label, unnest(u) AS x, unnest(range(len(u))) AS pos FROM u),
        centres AS (SELECT label, list(x ORDER BY pos) AS c FROM (SELECT label, pos, avg(x) AS x FROM xs GROUP BY ALL) GROUP BY label),
        toward AS (SELECT vec_id, label AS cell, list_cosine_similarity(u, c) AS near FROM (SELECT vec_id, u FROM u) CROSS JOIN centres),
        cells AS (SELECT vec_id, cell FROM toward QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY near DESC, cell) = 1),
        probed AS (SELECT vec_id AS qid, cell FROM toward QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY near DESC, cell) <= {PROBES}),
        chosen AS (SELECT u, row_number() OVER (ORDER BY md5(vec_id::VARCHAR), vec_id) AS code FROM u QUALIFY code <= {CODEWORDS}),
        words AS (SELECT code, p, u[{_WIDTH} * p + 1 : {_WIDTH} * (p + 1)] AS w FROM chosen, range({PARTS}) AS r(p)),
        pieces AS (SELECT vec_id, p, u[{_WIDTH} * p + 1 : {_WIDTH} * (p + 1)] AS x FROM u, range({PARTS}) AS r(p)),
        met AS (SELECT vec_id, p, code, list_dot_product(x, w) AS dot, list_sum(list_transform(list_zip(x, w), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS gap FROM pieces JOIN words USING (p)),
        codes AS (SELECT vec_id, p, code FROM met QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY gap, code) = 1),
        approximate AS (
          SELECT m.vec_id AS qid, c.vec_id, round(sum(m.dot), 9) AS score FROM codes c JOIN met m ON m.p = c.p AND m.code = c.code GROUP BY ALL),
        listed AS (
          SELECT qid, vec_id FROM approximate JOIN cells USING (vec_id) JOIN probed USING (qid, cell)
          QUALIFY row_number() OVER (PARTITION BY qid ORDER BY approximate.score DESC, vec_id) <= {SHORT_LIST}),
        best AS (
          SELECT qid, vec_id, score FROM listed JOIN pairs USING (qid, vec_id)
          QUALIFY row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id) <= 6)"""
    + _top("(SELECT * FROM best WHERE qid <> vec_id)", 5),
}
