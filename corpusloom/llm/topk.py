"""Exact top-k search by tiled matrix products."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.store import stored

TILE_ROWS = 8192  # queries and candidates on the sides of a tile, about
FAN_IN = 16  # lists merged into one in each round of the tree
STEP = 512  # queries multiplied at a time


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products. Floating point is used where every sum is below its whole-number
    range, Python integers where even 64 bits might not do; those are clipped to the long range."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if bound < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if bound < 1 << 53:
        return (a @ b.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)
    return np.clip(whole(a) @ whole(b).T, -(2**63) + 1, 2**63 - 1).astype(np.int64)


def _select(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k best of each row; columns are in order of id, so ties go to the left."""
    rows, columns = [], []
    for r in range(len(scores)):
        line = scores[r]
        at = np.flatnonzero(ids != own[r])
        if len(at) > 4 * k + 4:
            floor = np.partition(line[at], len(at) - k)[len(at) - k]
            at = at[line[at] >= floor]
        best = at[np.argsort(-line[at].astype(np.float64) if np.abs(line[at]).max(initial=0) < 1 << 53 else np.array([-int(x) for x in line[at]], object), kind="stable")[:k]]
        rows.append(np.full(len(best), r))
        columns.append(best)
    return np.concatenate(rows), np.concatenate(columns)


def _tile(k: int):
    """The k best candidates of a tile for each of its queries."""

    def search(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out = {"query_id": [], "shard": [], "vec_id": [], "score": []}
        if queries.num_rows and candidates.num_rows:
            candidates = candidates.sort_by("vec_id")
            a = _matrix(queries["vector"].combine_chunks())
            b = _matrix(candidates["vector"].combine_chunks())
            ids = candidates["vec_id"].to_numpy()
            asked = queries["vec_id"].to_numpy()
            for x in range(0, len(a), STEP):
                scores = _exact_scores(a[x : x + STEP], b)
                row, column = _select(scores, ids, asked[x : x + STEP], k)
                out["query_id"].append(asked[x : x + STEP][row])
                out["vec_id"].append(ids[column])
                out["score"].append(scores[row, column])
        shard = candidates["shard"][0].as_py() if candidates.num_rows else 0
        flat = {c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in out.items() if c != "shard"}
        return pa.table(
            {"query_id": flat["query_id"], "shard": np.full(len(flat["score"]), shard, np.int32), "vec_id": flat["vec_id"], "score": flat["score"]}
        )

    return search


def top_k(
    rows: DataFrame, queries: DataFrame, k: int, id_: str = "vec_id", vector: str = "embedding", tile_rows: int = TILE_ROWS
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the k rows of the highest inner product of
    the vectors' components ``floor(64 * x)``, other than itself; ties go to the smaller id.

    Queries and rows are dealt by hash into blocks of about ``tile_rows``; every pair of a query
    block and a row block is one tile, multiplied and cut to k per query in one task. The lists of a
    query are merged ``FAN_IN`` at a time, so no task holds more than ``FAN_IN * k`` of one query.

    Defined results: vectors that are null, empty or hold a null or non-finite component take no
    part, nor do rows without id; vectors are only compared with those of their own length; rows of
    one id are candidates each, as often as they are there, but none of them for the query of that
    id; a query that is there more than once is asked once, of several vectors of one id the lowest;
    scores are clipped to the long range.
    """
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = F.col(id_).isNotNull() & (F.size(vector) > 0) & F.forall(F.col(vector), lambda x: F.coalesce(fine(x.cast("double")), F.lit(False)))
    # floor() of a double is a long, which is too small for the largest floats; those stay doubles.
    scaled = lambda x: F.when(F.abs(x) < float(1 << 50), F.floor(F.lit(64.0) * x).cast("double")).otherwise(F.lit(64.0) * x)
    whole = F.transform(F.col(vector), lambda x: scaled(x.cast("double")))
    pick = lambda df: df.where(usable).select(F.col(id_).cast("bigint").alias("vec_id"), whole.alias("vector"))
    rows, queries = stored(pick(rows), "candidates"), stored(pick(queries).groupBy("vec_id").agg(F.min("vector").alias("vector")), "queries")
    n_rows, n_queries = rows.count(), queries.count()
    shards, blocks = max(1, -(-n_rows // tile_rows)), max(1, -(-n_queries // tile_rows))
    spread = rows.sparkSession.sparkContext.defaultParallelism
    shards = min(max(shards, -(-spread // blocks)), max(1, n_rows))
    number = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    hashed = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    asked = queries.select("vec_id", "vector", F.size("vector").alias("d"), hashed(blocks).alias("block"), F.explode(number(shards)).alias("shard"))
    held = rows.select("vec_id", "vector", F.size("vector").alias("d"), hashed(shards).alias("shard"), F.explode(number(blocks)).alias("block"))
    tiles = asked.groupBy("block", "shard", "d").cogroup(held.groupBy("block", "shard", "d"))
    found = tiles.applyInArrow(_tile(k), "query_id bigint, shard int, vec_id bigint, score bigint")
    entry = F.struct((-F.col("score")).alias("low"), F.col("vec_id"))
    lists = found.groupBy("query_id", "shard").agg(F.sort_array(F.collect_list(entry)).alias("best"))
    while shards > 1:
        shards = -(-shards // FAN_IN)
        merged = lists.groupBy("query_id", F.floor(F.col("shard") / FAN_IN).cast("int").alias("shard"))
        lists = merged.agg(F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
    best = lists.select("query_id", F.posexplode("best").alias("at", "x"))
    return best.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.low")).alias("score"))
