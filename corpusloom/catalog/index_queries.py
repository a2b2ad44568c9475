"""The chunk index: building, storing, reporting, routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog import sql
from corpusloom.catalog.tables import documents, questions, table
from corpusloom.functions.vectors import model_embedder
from corpusloom.operators.shards import DEFAULT_SHARDS, ask_every_shard, pose_question, registry, rendezvous_shard, shard_registry, shard_report
from corpusloom.plans.indexing import index_objects, rejected
from corpusloom.plans.reindex import add_shard, build_index, update_index
from corpusloom.session import work_folder
from corpusloom.sinks.index import write_index
from corpusloom.sources.index import read_index


def _objects(spark, sf_dir):
    return index_objects(documents(spark, sf_dir), ["doc_id"])


def index_rows(spark, sf_dir):
    objects = _objects(spark, sf_dir)
    return objects.select(
        "doc_id",
        F.col("chunk_ix").cast("bigint").alias("chunk_ix"),
        "context",
        F.col("shard").cast("bigint").alias("shard"),
        F.size("vector").cast("bigint").alias("dim"),
    )


def index_shard_report(spark, sf_dir):
    return _as_bigints(shard_report(_objects(spark, sf_dir)))


def stored_index_report(spark, sf_dir):
    """The same, from an index that was written and read back."""
    path = work_folder(spark, "index")
    write_index(_objects(spark, sf_dir), path)
    return _as_bigints(shard_report(read_index(spark, path)))


def stored_shard(spark, sf_dir):
    """One shard of a written index: a read of that partition only."""
    path = work_folder(spark, "index")
    write_index(_objects(spark, sf_dir), path, compact=True)
    return read_index(spark, path, [3]).select("doc_id", F.col("chunk_ix").cast("bigint").alias("chunk_ix"), "context")


def _reindexed(spark, sf_dir):
    """An index of an earlier state of the documents (some texts other, some documents absent, some
    since gone) brought up to date. Gives the index's path and the report."""
    docs, path = documents(spark, sf_dir), work_folder(spark, "index")
    place = F.col("doc_id") % 10
    other = F.when(place == 3, F.concat(F.lit("formerly "), "text")).otherwise(F.col("text"))
    gone = docs.where(place == 7).select((-F.col("doc_id")).alias("doc_id"), "text")
    earlier = docs.where(place != 5).withColumn("text", other).unionByName(gone)
    build_index(earlier, path, ["doc_id"])
    return path, update_index(spark, docs, path, ["doc_id"])


def reindexed_rows(spark, sf_dir):
    """The rows of an index after an update are those of an index built anew."""
    rows = read_index(spark, _reindexed(spark, sf_dir)[0])
    return rows.select("doc_id", F.col("chunk_ix").cast("bigint").alias("chunk_ix"), "context", F.col("shard").cast("bigint").alias("shard"), "digest")


def reindex_report(spark, sf_dir):
    return _reindexed(spark, sf_dir)[1]


def grown_shards(spark, sf_dir):
    """Shards of the chunks of an index before and after it was given a sixth one."""
    path, keys = work_folder(spark, "index"), ["doc_id", "chunk_ix"]
    write_index(index_objects(documents(spark, sf_dir), ["doc_id"], place=rendezvous_shard), path)
    before = work_folder(spark, "placed")
    read_index(spark, path).select(*keys, F.col("shard").cast("bigint").alias("before")).write.parquet(before)
    add_shard(spark, path, ["doc_id"], DEFAULT_SHARDS)
    after = read_index(spark, path).select(*keys, F.col("shard").cast("bigint").alias("after"))
    return spark.read.parquet(before).join(after, keys).withColumn("chunk_ix", F.col("chunk_ix").cast("bigint"))


def _as_bigints(report):
    return report.select(*[F.col(c).cast("bigint").alias(c) for c in report.columns])


def _fragile_model():
    """Stand-in for a user's model that fails on some texts."""

    def encode(texts):
        if any("ß" in text for text in texts):
            raise ValueError("unknown letter")
        return [[float(len(text)), 1.0, 0.0][: 3 if "ç" in text else 2] for text in texts]

    return encode


def rejected_chunks(spark, sf_dir):
    """Chunks whose embedding failed, with what the model raised, or gave a vector of the wrong length;
    the others of their batch are kept."""
    objects = index_objects(documents(spark, sf_dir), ["doc_id"], embed=model_embedder(_fragile_model, dim=2))
    return rejected(objects).select("doc_id", F.col("chunk_ix").cast("bigint").alias("chunk_ix"), "context", "error")


def registry_shards(spark, sf_dir):
    """Shard numbers of names that end in a number; one name stands for the gateway."""
    names = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"))
    return shard_registry(names, gateway="Supplier#000000007")


def registry_rows(spark, sf_dir):
    """The registry of a service per nation, from entries that have a key too many and lack another."""
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name").collect()
    services = [{"name": n.n_name, "ip": None if n.n_nationkey % 5 == 0 else f"10.0.0.{n.n_nationkey}", "port": 8000 + n.n_nationkey, "protocol": "http"} for n in nations]
    return registry(spark, services)


def posed_question(spark, sf_dir):
    """The registry's shards with one question put to all of them."""
    names = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.lit(None).cast("int").alias("query"))
    return pose_question(shard_registry(names), "What is the capital of France?")


def question_shards(spark, sf_dir):
    asked = ask_every_shard(questions(spark, sf_dir))
    return asked.withColumn("shard", F.col("shard").cast("bigint"))


QUERIES = {
    "index_rows": index_rows,
    "index_shard_report": index_shard_report,
    "stored_index_report": stored_index_report,
    "stored_shard": stored_shard,
    "reindexed_rows": reindexed_rows,
    "reindex_report": reindex_report,
    "grown_shards": grown_shards,
    "rejected_chunks": rejected_chunks,
    "registry_shards": registry_shards,
    "registry_rows": registry_rows,
    "posed_question": posed_question,
    "question_shards": question_shards,
}

_SHARD = sql.shard("doc_id, chunk_ix")
_REPORT = f"""
    WITH {sql.chunks()}, n AS (SELECT {_SHARD}::BIGINT AS shard, count(*) AS objects FROM chunks GROUP BY ALL)
    SELECT shard, objects, objects // 100 AS full_batches, objects % 100 AS remainder, CAST(ceil(objects / 100.0) AS BIGINT) AS batches FROM n"""



def _rendezvous(shards: int) -> str:
    weights = ", ".join(f"{{'w': md5('{s}/' || concat_ws('/', doc_id, chunk_ix)), 's': -{s}}}" for s in range(shards))
    return f"-(list_max([{weights}]).s)::BIGINT"


ORACLE = {
    "grown_shards": f"WITH {sql.chunks()} SELECT doc_id, chunk_ix, {_rendezvous(5)} AS before, {_rendezvous(6)} AS after FROM chunks",
    "index_rows": f"WITH {sql.chunks()} SELECT doc_id, chunk_ix, chunk AS context, {_SHARD}::BIGINT AS shard, 256::BIGINT AS dim FROM chunks",
    "index_shard_report": _REPORT,
    "stored_index_report": _REPORT,
    "stored_shard": f"WITH {sql.chunks()} SELECT doc_id, chunk_ix, chunk AS context FROM chunks WHERE {_SHARD} = 3",
    "reindexed_rows": f"WITH {sql.chunks()} SELECT doc_id, chunk_ix, chunk AS context, {_SHARD}::BIGINT AS shard, md5(text) AS digest FROM chunks JOIN documents USING (doc_id)",
    "reindex_report": f"""
        WITH n AS (SELECT doc_id, len({sql.words('text')}) AS words FROM documents),
        states AS (
          SELECT CASE WHEN words = 0 THEN 'empty' WHEN doc_id % 10 IN (3, 5) THEN 'embedded' ELSE 'kept' END AS state FROM n
          UNION ALL SELECT 'removed' FROM n WHERE doc_id % 10 = 7 AND words > 0)
        SELECT state, count(*) AS documents FROM states GROUP BY state""",
    "rejected_chunks": f"""
        WITH {sql.chunks()}
        SELECT doc_id, chunk_ix, chunk AS context,
          CASE WHEN contains(chunk, 'ß') THEN 'ValueError: unknown letter' ELSE 'vector of 3 values where 2 finite ones, not all of them 0, are needed' END AS error
        FROM chunks WHERE contains(chunk, 'ß') OR contains(chunk, 'ç')""",
    "registry_shards": """
        SELECT s_name AS name, CAST(regexp_extract(s_name, '([0-9]+)$', 1) AS BIGINT) - 1 AS shard
        FROM supplier WHERE s_name <> 'Supplier#000000007'""",
    "registry_rows": """
        SELECT n_name AS name, CASE WHEN n_nationkey % 5 <> 0 THEN '10.0.0.' || n_nationkey END AS ip, (8000 + n_nationkey)::VARCHAR AS port, NULL::VARCHAR AS query
        FROM nation""",
    "posed_question": """
        SELECT s_name AS name, 'What is the capital of France?' AS query, CAST(regexp_extract(s_name, '([0-9]+)$', 1) AS BIGINT) - 1 AS shard
        FROM supplier""",
    "question_shards": """
        SELECT conv_id, turn AS seq, text AS query, s.range AS shard FROM conversations, range(5) s WHERE role = 'user'""",
}
