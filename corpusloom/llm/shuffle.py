"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix."""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.store import packed, stored

SHARDS = 16
SEED = 20240229
BUCKET_ROWS = 5000
RANK_BITS = 33  # monotonically_increasing_id() keeps the place in the partition in these


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` taken from ``good + bad`` are good. Beyond the generator's range of
    1e9 by the normal law of the same mean and variance, kept to what is possible."""
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, drawn)) if drawn else 0
    n = good + bad
    mean = drawn * good / n
    spread = math.sqrt(max(0.0, mean * (bad / n) * ((n - drawn) / max(1, n - 1))))
    return min(max(round(rng.normal(mean, spread)), drawn - bad, 0), good, drawn)


def communication_matrix(partitions: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows that each partition sends to each shard, drawn as a uniform shuffle would have them:
    rows add up to the partitions' sizes, columns to the shards', which differ by one at most."""
    rng = np.random.default_rng(seed)
    total = sum(partitions)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    out = []
    for n in partitions:
        rest, row = sum(room), []
        for s in range(shards):
            rest -= room[s]
            row.append(hypergeometric(rng, room[s], rest, n))
            n -= row[-1]
        room = [a - b for a, b in zip(room, row)]
        out.append(row)
    return out


def shuffled(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """All rows with ``shard`` and ``slot`` (from 0, gapless in a shard): a uniform shuffle in which
    the shards' sizes differ by one row at most.

    Every source partition is put in random order and stored with its rows' places. The matrix of
    how many rows each partition sends to each shard needs only the partitions' sizes; a row's
    shard follows from its place. One exchange, by shard and random bucket, brings the rows
    together, each bucket is put in random order again, and its first slot is the number of rows in
    the buckets before it. A bucket holds about ``bucket_rows``, so neither a shard nor a repeated
    row is one task's work.

    Defined results: rows are not looked at, so nulls, ties and repeated rows are dealt like any
    other; an empty table gives no rows; columns named ``shard`` or ``slot`` are replaced.
    """
    permuted = packed(docs).withColumn("u", F.rand(seed)).sortWithinPartitions("u")
    place = F.monotonically_increasing_id()
    permuted = permuted.select("row", F.shiftright(place, RANK_BITS).alias("part"), place.bitwiseAND(F.lit((1 << RANK_BITS) - 1)).alias("place"))
    permuted = stored(permuted, "permuted")
    sizes = dict(permuted.groupBy("part").count().collect())
    matrix = communication_matrix([sizes.get(p, 0) for p in range(max(sizes, default=-1) + 1)], shards, seed)
    bounds = [np.cumsum(row)[:-1].tolist() for row in matrix]
    limits = F.from_json(F.lit(json.dumps(bounds)), "array<array<bigint>>")
    shard = F.size(F.filter(F.get(limits, F.col("part").cast("int")), lambda b: b <= F.col("place")))
    buckets = max(1, -(-sum(sizes.values()) // (shards * bucket_rows)))
    key = F.xxhash64(F.lit(seed), "part", "place")
    dealt = permuted.select("row", "part", "place", shard.alias("shard"), key.alias("key"), F.pmod(key, F.lit(buckets)).alias("bucket"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    firsts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "bucket").orderBy("key", "part", "place")
    ranked = dealt.withColumn("nth", F.row_number().over(within)).join(firsts, ["shard", "bucket"])
    own = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("shard", "slot")]
    return ranked.select(*own, "shard", (F.col("first") + F.col("nth") - 1).alias("slot"))
