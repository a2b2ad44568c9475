import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import Observation
from pyspark.sql import functions as F

from corpusloom.functions.vectors import hashed_counts, model_embedder
from corpusloom.operators.cells import assign_cells, fit_cells, nearest_in_cells
from corpusloom.operators.chunking import tokenizer_hooks
from corpusloom.operators.shards import ask_every_shard, registry, shard_registry, shard_report
from corpusloom.plans.indexing import accepted, index_objects, rejected
from corpusloom.plans.jobs import FILE_KEYS, index_job
from corpusloom.plans.retrieval import ask, fetch_context, find_matches, generate_answers
from corpusloom.session import build_session, spread, work_folder
from corpusloom.sinks.index import replace_shards, write_index
from corpusloom.sources.index import read_index, read_rejects

cloudpickle.register_pickle_by_value(sys.modules[__name__])
KEYS = ["doc_id", "chunk_ix"]


def docs(spark, n=30):
    rows = [(i, " ".join(f"word{(i * 7 + j) % 50}" for j in range(i * 11))) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_every_chunk_in_exactly_one_shard(spark):
    objects = index_objects(docs(spark), ["doc_id"]).cache()
    assert rejected(objects).count() == 0
    assert objects.count() == accepted(objects).count() == objects.select(*KEYS).distinct().count()
    assert {r["shard"] for r in objects.select("shard").distinct().collect()} <= set(range(5))
    again = index_objects(docs(spark).repartition(2), ["doc_id"])
    assert objects.select(*KEYS, "shard").exceptAll(again.select(*KEYS, "shard")).count() == 0
    report = shard_report(objects, batch=10).collect()
    assert sum(r["objects"] for r in report) == objects.count()
    assert all(r["full_batches"] * 10 + r["remainder"] == r["objects"] and r["batches"] - r["full_batches"] == (r["remainder"] > 0) for r in report)


def odd_model():
    def encode(texts):
        if "word3" in " ".join(texts).split():
            raise ValueError
        return [[1.0] if "word4" in t.split() else [1.0, float(len(t))] for t in texts]

    return encode


def test_rejects_are_stored_apart(spark, tmp_path):
    path = str(tmp_path / "index")
    objects = index_objects(docs(spark), ["doc_id"], embed=model_embedder(odd_model, batch=8), dim=2)
    write_index(objects, path)
    good, bad = read_index(spark, path), read_rejects(spark, path)
    assert good.count() + bad.count() == index_objects(docs(spark), ["doc_id"]).count()
    errors = {r["error"] for r in bad.collect()}
    assert "ValueError: " in errors and errors <= {"ValueError: ", "vector of 1 values where 2 finite ones, not all of them 0, are needed"}
    assert {r["error"] for r in good.collect()} == {None}
    words = [set(r["context"].split()) for r in bad.collect()]
    assert words and all(w & {"word3", "word4"} for w in words)
    assert not any({"word3", "word4"} & set(r["context"].split()) for r in good.collect())


def failing_tokenizer():
    class Adapter:
        def encode(self, text):
            if "word1" in text.split():
                raise ValueError("no such word")
            return [ord(c) for c in text]

        def decode(self, ids):
            return "".join(map(chr, ids)) if ids[0] != ord("w") else 1 / 0

    return Adapter()


def test_refused_texts_are_indexed_as_rejects(spark, tmp_path):
    tokenize, detokenize = tokenizer_hooks(failing_tokenizer)
    few = spark.createDataFrame([(1, "word1 and"), (2, "word2 and"), (3, "and word3")], "doc_id long, text string")
    seen = Observation()
    objects = index_objects(few, ["doc_id"], tokenize=tokenize, detokenize=detokenize, observation=seen)
    write_index(objects, str(tmp_path / "index"))
    assert seen.get == {"indexed": 1, "refused": 2}
    refused = {(r.doc_id, r.chunk_ix, r.error) for r in read_rejects(spark, str(tmp_path / "index")).collect()}
    assert refused == {(1, None, "ValueError: no such word"), (2, 0, "ZeroDivisionError: division by zero")}
    with pytest.raises(ValueError, match="give dim"):
        index_objects(few, ["doc_id"], embed=model_embedder(odd_model))


def test_writing_again(spark, tmp_path):
    path = str(tmp_path / "index")
    first = index_objects(docs(spark), ["doc_id"]).cache()
    write_index(first, path)
    write_index(first.limit(1), path, replace=False)
    assert read_index(spark, path).count() == first.count()
    replace_shards(first.where("shard = 2").limit(1), path)
    counts = {r["shard"]: r["objects"] for r in shard_report(read_index(spark, path)).collect()}
    expected = {r["shard"]: r["objects"] for r in shard_report(first).collect()} | {2: 1}
    assert counts == expected
    write_index(first.where("shard = 1"), path, compact=True)
    assert {r["shard"] for r in read_index(spark, path).select("shard").distinct().collect()} == {1}


def test_reading_one_shard_prunes(spark, tmp_path):
    path = str(tmp_path / "index")
    write_index(index_objects(docs(spark), ["doc_id"]), path)
    plan = read_index(spark, path, [3]).select("context")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(shard" in plan and "ReadSchema: struct<context:string>" in plan


def test_index_stored_by_cell(spark, tmp_path):
    path = str(tmp_path / "cells")
    objects = accepted(index_objects(docs(spark), ["doc_id"]))
    model = fit_cells(objects, 4)
    write_index(assign_cells(objects, model), path, compact=True, by="cell")
    questions = spark.createDataFrame([(0, "word1 word2")], "qid long, query string")
    asked = questions.select("qid", hashed_counts()(F.col("query")).alias("vector"))
    matches = nearest_in_cells(asked, spark.read.parquet(path), model, 2, 1, asked_keys=["qid"], item_keys=KEYS)
    assert matches.count() == 2
    assert "PartitionFilters: [isnotnull(cell" in matches._jdf.queryExecution().toString()


def test_questions(spark):
    index = index_objects(docs(spark), ["doc_id"])
    questions = spark.createDataFrame([(1, "word1 word2 word3"), (2, "   "), (3, None), (4, "zzz")], "qid long, query string")
    matches = find_matches(questions, index, ["qid"], KEYS, shard_k=2, k=3)
    answers = {r["qid"]: r for r in fetch_context(questions, matches, ["qid"]).collect()}
    assert set(answers) == {1, 2, 3, 4}
    assert len(answers[1]["context"]) == 3 and answers[1]["prompt"].endswith("Question:\nword1 word2 word3\n\nAnswer:")
    for empty in (2, 3):
        assert answers[empty]["context"] is None and answers[empty]["prompt"] is None and answers[empty]["certainty"] is None
    ranked = matches.where("qid = 1").orderBy("match_rank").collect()
    assert [r["rag_text"] for r in ranked] == answers[1]["context"]
    assert answers[1]["certainty"] == ranked[0]["certainty"] == max(r["certainty"] for r in ranked)
    one = ask(index, KEYS, "word1 word2 word3")
    assert one["rag_text"] == answers[1]["context"][:1] and one["certainty"] == answers[1]["certainty"]
    assert ask(index, KEYS, "") == {"rag_text": None, "certainty": None, "distance": None}


def test_search_reads_the_index_once(spark, tmp_path):
    path = str(tmp_path / "index")
    write_index(index_objects(docs(spark), ["doc_id"]).withColumn("unused", F.lit("x" * 50)), path)
    questions = spark.createDataFrame([(1, "word1")], "qid long, query string")
    plan = find_matches(questions, read_index(spark, path), ["qid"], KEYS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan
    assert "ReadSchema: struct<doc_id:bigint,chunk_ix:int,context:string,vector:array<float>>" in plan


def test_generator_hook(spark):
    prompts = spark.createDataFrame([(1, "ab"), (2, None)], "i int, prompt string")
    pieces = generate_answers(prompts, lambda: (lambda p: (c + "." for c in p))).orderBy("i").collect()
    assert [r["answer"] for r in pieces] == ["a.b.", None]
    assert generate_answers(prompts, lambda: str.upper).orderBy("i").first()["answer"] == "AB"


def test_registry(spark):
    services = [
        {"ip": "10.0.0.1", "port": 8080, "protocol": "TCP", "name": "node-1"},
        {"ip": "10.0.0.2", "port": 8080, "protocol": "TCP", "name": "node-10"},
        {"ip": "10.0.0.9", "port": 50051, "protocol": "TCP", "name": "grpc"},
    ]
    rows = shard_registry(registry(spark, services)).orderBy("shard").collect()
    assert [tuple(r) for r in rows] == [("node-1", "10.0.0.1", "8080", None, 0), ("node-10", "10.0.0.2", "8080", None, 9)]
    asked = ask_every_shard(spark.createDataFrame([(1,)], "qid long"), 3)
    assert sorted(tuple(r) for r in asked.collect()) == [(1, 0), (1, 1), (1, 2)]


def test_index_job(spark, tmp_path):
    for topic, name, text in [("Law", "a.txt", "law court " * 50), ("Art", "a.txt", "paint"), ("Art", "empty.txt", "")]:
        (tmp_path / "in" / topic).mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / topic / name).write_text(text)
    report = index_job(spark, str(tmp_path / "in"), str(tmp_path / "index"), files=True)
    index = read_index(spark, str(tmp_path / "index"))
    assert sum(r["objects"] for r in report.collect()) == index.count() == 2 + 1
    assert ask(index, [*FILE_KEYS, "chunk_ix"], "paint")["rag_text"] == ["paint"]


class Unset:
    """A session whose checkpoint folder is unset."""

    def __init__(self, master):
        self.conf = {}
        self.sparkContext = type("Context", (), {"master": master})


def test_work_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert work_folder(spark, "x").startswith(shared) and work_folder(spark, "x") != work_folder(spark, "x")
    assert "corpusloom" in work_folder(Unset("local[2]"), "x")
    with pytest.raises(ValueError):
        work_folder(Unset("spark://host:7077"), "x")


def test_spread_leaves_wide_scans_alone(spark):
    wide = spark.range(100).repartition(16)
    assert spread(wide, "id") is wide
    assert spread(spark.range(100).coalesce(1), "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert build_session().conf.get("spark.sql.adaptive.enabled") == "true"


def test_each_question_is_asked_once(spark, monkeypatch, tmp_path):
    """One search a question, however many of the answer's columns are wanted."""
    from corpusloom.catalog import chat_queries

    asked = []
    ask = lambda index, keys, question: asked.append(question) or {"rag_text": None, "certainty": None, "distance": None}
    monkeypatch.setattr(chat_queries, "ask", ask)
    assert chat_queries.asked_once(spark, "/root/testdata/sf0.001").count() == 2
    assert len(asked) == 2 and asked[1] == " "
