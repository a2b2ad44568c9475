import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.postings import build_postings, document_frequencies, read_postings, search_postings, write_postings
from corpusloom.operators import search
from corpusloom.operators.search import keyword_search


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Documents with a skewed vocabulary and many copies, their topics, and the stored index."""
    rng = random.Random(5)
    texts = [" ".join(rng.choice("aaabcdefgh") * rng.choice([1, 1, 2]) for _ in range(rng.randrange(40))) for _ in range(600)]
    texts += ["a b c a"] * 300 + [None, "", " \t", "A B " * 500]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    docs = docs.unionByName(spark.createDataFrame([(3, "zz a"), (None, "a b c")], docs.schema))
    queries = [" ".join(rng.choice("abcdefghz") for _ in range(rng.randrange(1, 4))) for _ in range(40)] + ["", "A a", "zz a"]
    topics = spark.createDataFrame(list(enumerate(queries)), "topic long, query string")
    path = str(tmp_path_factory.mktemp("postings"))
    write_postings(build_postings(docs, block_docs=20, buckets=4), path)
    return docs, topics, path


@pytest.mark.parametrize("limit, seeds", [(1, 1), (7, 2), (30, 8), (10_000, 3)])
def test_search_equals_the_scan(spark, corpus, limit, seeds):
    docs, topics, path = corpus
    expected = keyword_search(docs.where("doc_id is not null"), topics, limit=limit)
    got = search_postings(read_postings(spark, path), topics, limit=limit, buckets=4, seeds=seeds)
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in expected.collect())
    assert got.columns == expected.columns


def test_rows_are_bounded_and_in_order(spark, corpus):
    docs, _, path = corpus
    postings = read_postings(spark, path)
    assert postings.agg(F.max("n_docs")).first()[0] < 60
    sums = postings.select((F.size("postings") == F.col("n_docs")).alias("n"), (F.array_max("postings.n") == F.col("most")).alias("m"))
    assert sums.where("not n or not m").isEmpty()
    expected = docs.where("doc_id is not null").select("doc_id", F.explode(F.array_distinct(F.split(F.lower("text"), r"(?U)\s+"))).alias("term"))
    expected = {r.term: r["count"] for r in expected.where("term <> ''").distinct().groupBy("term").count().collect()}
    assert {r.term: r.docs for r in document_frequencies(postings).collect()} == expected


def test_only_wanted_postings_are_read(spark, corpus, tmp_path):
    """The plan has no text, the bounds are found without postings, folders and row groups are pruned."""
    _, topics, path = corpus
    found = search_postings(read_postings(spark, path), topics, limit=5, buckets=4)
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scans and all(path in line and "text" not in line.split("ReadSchema")[1] for line in scans)
    assert any("n_docs" in line or "most" in line for line in scans if "postings:array" not in line)
    assert all("PartitionFilters: []" not in line and "PushedFilters: []" not in line for line in scans)


def test_a_block_is_counted_in_its_task(spark, corpus):
    """Only texts move to build the index; words are neither sorted nor shuffled, nor read twice to be placed."""
    docs, _, path = corpus
    built = build_postings(docs, block_docs=20, buckets=4)
    plan = built._jdf.queryExecution().executedPlan().toString()
    given = docs._jdf.queryExecution().executedPlan().toString()
    assert "explode(" not in plan and plan.count("Exchange") == given.count("Exchange") + 1
    keys = docs.where("doc_id is not null").select(F.concat(F.lit("é"), F.col("doc_id").cast("string")).alias("name"), F.col("text"))
    named = build_postings(keys, doc_key="name", block_docs=20, buckets=4).select("term", F.explode("postings").alias("p"))
    named = {(r.term, r.p["name"]): r.p["n"] for r in named.collect()}
    rows = read_postings(spark, path).select("term", F.explode("postings").alias("p")).collect()
    assert named == {(r.term, f"é{r.p['doc_id']}"): r.p["n"] for r in rows}


def test_nothing_to_find(spark, corpus, tmp_path):
    docs, topics, path = corpus
    assert search_postings(read_postings(spark, path), topics.where("false"), buckets=4).count() == 0
    write_postings(build_postings(docs.where("false"), block_docs=20, buckets=4), str(tmp_path / "none"))
    none = spark.read.schema(read_postings(spark, path).schema).parquet(str(tmp_path / "none"))
    assert search_postings(none, topics, buckets=4).count() == 0


def test_few_topics_move_no_texts_or_maps_by_term(spark, corpus, monkeypatch):
    """Neither words nor a document's counts are shuffled by term; many topics give the same rows."""
    docs, topics, _ = corpus
    found = keyword_search(docs, topics, limit=30)
    expected = sorted(tuple(r) for r in found.collect())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert expected and "SortMergeJoin" not in plan
    monkeypatch.setattr(search, "BROADCAST_TERMS", 5)
    assert sorted(tuple(r) for r in keyword_search(docs, topics, limit=30).collect()) == expected
