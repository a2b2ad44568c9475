import sys
from pathlib import Path

from pyspark import cloudpickle
from pyspark.sql import functions as F

from corpusloom.functions.vectors import model_embedder
from corpusloom.operators.shards import rendezvous_shard
from corpusloom.plans.indexing import index_objects
from corpusloom.plans.reindex import add_shard, build_index, digested, update_index
from corpusloom.sinks.index import write_index

cloudpickle.register_pickle_by_value(sys.modules[__name__])
DOCS = "doc_id long, text string"


def rows_of(df):
    return sorted(((r.doc_id, r.chunk_ix, r.context, tuple(r.vector or ()), r.shard, r.digest) for r in df.collect()), key=str)


def test_only_changes_are_embedded(spark, tmp_path):
    path = str(tmp_path / "index")
    seen = spark.sparkContext.accumulator(0)

    def counting_model():
        def encode(texts):
            seen.add(len(texts))
            return [[1.0, float(len(t))] for t in texts]

        return encode

    options = dict(embed=model_embedder(counting_model), dim=2, shards=4)
    first = [(i, f"word{i} " * (1 + i % 3)) for i in range(40)] + [(None, "no key"), (50, ""), (51, None), (60, "twin"), (60, "twin")]
    build_index(spark.createDataFrame(first, DOCS), path, ["doc_id"], **options)
    start = seen.value

    second = [(i, t) if i not in (3, 4) else (i, "new text") for i, t in first if i not in (7, 8)]
    second = [r for r in second if r != (60, "twin")] + [(60, "twin"), (70, "added"), (50, "")]
    now = spark.createDataFrame(second, DOCS)
    report = {r.state: r.documents for r in update_index(spark, now, path, ["doc_id"], **options).collect()}
    # Two changed, one added, and one of which a copy is gone.
    assert seen.value - start == 4
    assert report == {"kept": 37, "embedded": 4, "removed": 2, "empty": 2}
    anew = index_objects(digested(now), ["doc_id"], carry=["digest"], **options)
    assert rows_of(spark.read.parquet(path)) == rows_of(anew)

    # The same again: nothing is embedded and no file is touched.
    start, files = seen.value, {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}
    report = {r.state: r.documents for r in update_index(spark, now, path, ["doc_id"], **options).collect()}
    assert seen.value == start and report == {"kept": 41, "empty": 2}
    assert files == {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_only_touched_shards_are_written(spark, tmp_path):
    path = str(tmp_path / "index")
    docs = spark.createDataFrame([(i, f"word{i}") for i in range(30)], DOCS)
    build_index(docs, path, ["doc_id"], shards=9)
    files = lambda: {p.parent.name: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}
    before = files()
    (place,) = {r.shard for r in spark.read.parquet(path).where("doc_id = 5").collect()}
    update_index(spark, docs.withColumn("text", F.when(F.col("doc_id") == 5, "other").otherwise(F.col("text"))), path, ["doc_id"], shards=9).collect()
    after = files()
    assert {s for s in before if before[s] != after[s]} == {f"shard={place}"}

    # A shard that loses its last row goes.
    left = spark.read.parquet(path).where(f"shard <> {place}").select("doc_id").distinct()
    update_index(spark, docs.join(left, "doc_id"), path, ["doc_id"], shards=9).collect()
    assert set(files()) == set(before) - {f"shard={place}"}
    update_index(spark, docs, path, ["doc_id"], shards=9).collect()
    assert spark.read.parquet(path).count() == 30


def test_a_new_shard_takes_only_its_share(spark, tmp_path):
    path = str(tmp_path / "index")
    docs = spark.createDataFrame([(i, f"word{i}") for i in range(600)] + [(None, "x")], DOCS)
    write_index(index_objects(docs, ["doc_id"], shards=4, place=rendezvous_shard), path)
    before = {(r.doc_id, r.chunk_ix): r.shard for r in spark.read.parquet(path).collect()}
    assert set(before.values()) == {0, 1, 2, 3}
    moved = add_shard(spark, path, ["doc_id"], 4)
    rows = spark.read.parquet(path)
    after = {(r.doc_id, r.chunk_ix): r.shard for r in rows.collect()}
    changed = {k for k in before if before[k] != after[k]}
    assert rows.count() == 601 and len(changed) == moved and {after[k] for k in changed} == {4}
    assert 80 < moved < 160
    assert add_shard(spark, path, ["doc_id"], 4) == 0
