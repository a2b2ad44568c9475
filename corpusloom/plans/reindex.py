"""Keeping a stored index up to date: only what has changed is embedded and written."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.shards import REJECT_SHARD, rendezvous_shard
from corpusloom.plans.indexing import index_objects
from corpusloom.session import work_folder
from corpusloom.sinks.index import drop_shards, replace_shards, write_index

KEPT, EMBEDDED, REMOVED, EMPTY = "kept", "embedded", "removed", "empty"


def digested(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents with the digest of their text; a null text counts as empty."""
    return docs.withColumn("digest", F.md5(F.coalesce(F.col(text), F.lit(""))))


def build_index(docs: DataFrame, path: str, keys: list[str], text: str = "text", **options) -> None:
    """An index that ``update_index`` can keep up to date: its rows carry their document's digest."""
    write_index(index_objects(digested(docs, text), keys, text, carry=["digest"], **options), path)


def document_states(docs: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, state`` of every document there is or was: ``kept``, ``removed``, or ``changed`` if it is new
    or any of its texts differs.

    Both sides are counted by key and digest and meet in one aggregate, which treats null keys like
    any other. Only keys and digests of the index are read. Documents that gave no chunk are not in the
    index and always count as changed, which costs nothing, as they give none again.
    """
    now = docs.groupBy(*keys, "digest").agg(F.count("*").alias("now"), F.lit(0).cast("bigint").alias("then"))
    then = stored.where("chunk_ix = 0").groupBy(*keys, "digest").agg(F.lit(0).cast("bigint").alias("now"), F.count("*").alias("then"))
    texts = now.unionByName(then).groupBy(*keys, "digest").agg(F.sum("now").alias("now"), F.sum("then").alias("then"))
    per_key = texts.groupBy(*keys).agg(F.sum("now").alias("now"), F.max(F.col("now") != F.col("then")).alias("differs"))
    state = F.when(F.col("now") == 0, REMOVED).when(F.col("differs"), "changed").otherwise(KEPT)
    return per_key.select(*keys, state.alias("state"))


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def update_index(spark: SparkSession, docs: DataFrame, path: str, keys: list[str], text: str = "text", **options) -> DataFrame:
    """Bring the index under ``path`` to the given documents; ``options`` as it was built with.

    New and changed documents, told by their digests, are cut and embedded; those that are gone, and
    the old rows of changed ones, are left out. Only shards that lose or gain a row are written
    again, by partition overwrite, and shards with no row left are dropped; the other shards' files
    stay as they are, and no other document is embedded. Gives ``state, documents``: how many were
    ``kept``, ``embedded``, ``removed`` and, having no words, ``empty``.

    One update of an index may run at a time. Readers see the old files of a shard or the new ones.
    """
    docs = digested(docs, text)
    old = spark.read.parquet(path)
    states = work_folder(spark, "states")
    document_states(docs, old, keys).write.parquet(states)
    states = spark.read.parquet(states)
    changed = states.where("state = 'changed'")
    fresh = work_folder(spark, "fresh")
    index_objects(docs.join(changed, _same(docs, changed, keys), "left_semi"), keys, text, carry=["digest"], **options).write.parquet(fresh)
    fresh = spark.read.parquet(fresh)

    gone = states.where(F.col("state") != KEPT)
    losing = old.select(*keys, "shard").join(gone, _same(old, gone, keys), "left_semi").select("shard").distinct()
    touched = [r.shard for r in losing.unionByName(fresh.select("shard")).distinct().collect()]
    if touched:
        rest = old.where(F.col("shard").isin(touched))
        rest = rest.join(gone, _same(rest, gone, keys), "left_anti")
        rows = rest.select(fresh.columns).unionByName(fresh)
        emptied = set(touched) - {r.shard for r in rows.select("shard").distinct().collect()}
        replace_shards(rows, path)
        drop_shards(spark, path, sorted(emptied))

    embedded = fresh.select(*keys).distinct().agg(F.lit(EMBEDDED).alias("state"), F.count("*").alias("documents"))
    counted = states.where("state <> 'changed'").groupBy("state").agg(F.count("*").alias("documents"))
    n_changed = changed.agg(F.count("*").alias("n"))
    empty = embedded.join(F.broadcast(n_changed)).select(F.lit(EMPTY).alias("state"), (F.col("n") - F.col("documents")).alias("documents"))
    return counted.unionByName(embedded).unionByName(empty).where("documents > 0")


def add_shard(spark: SparkSession, path: str, keys: list[str], shards: int) -> int:
    """Give an index of ``shards`` shards, placed by ``rendezvous_shard``, one more; returns how many rows
    moved. Only the rows that the new shard takes change their place: which they are is told from
    the keys alone, nothing is embedded, and no row is shuffled. The shards they leave are written again.
    """
    old = spark.read.parquet(path)
    placed = F.when(F.col("shard") != REJECT_SHARD, rendezvous_shard([*keys, "chunk_ix"], shards + 1)).otherwise(F.col("shard"))
    moved = old.select("shard", placed.alias("place")).where("shard <> place").groupBy("shard").agg(F.count("*").alias("n"))
    leaving = {r["shard"]: r["n"] for r in moved.collect()}
    if leaving:
        rows = old.where(F.col("shard").isin(list(leaving)))
        left = {r["place"] for r in rows.select(placed.alias("place")).distinct().collect()}
        replace_shards(rows.withColumn("shard", placed.cast("int")), path)
        drop_shards(spark, path, sorted(set(leaving) - left))
    return sum(leaving.values())
