import json
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.search import DEFAULT_TOPICS, hits_per_topic, keyword_search
from corpusloom.plans.curate import cap_hits, curate, failed_pages, found_articles, monthly_views, most_viewed, resolve_hits, wanted_titles
from corpusloom.plans.extract import article_texts, safe_articles, unfetched_articles
from corpusloom.plans.jobs import curate_job, extract_job, index_job
from corpusloom.plans.retrieval import ask
from corpusloom.sinks.articles import write_article_files, write_failed_pages, write_named_files, write_ranked_lists
from corpusloom.sources.articles import read_article_files, read_ranked_arrays, read_ranked_lists
from corpusloom.sources.index import read_index
from corpusloom.sources.landed import daily_views_of_json, read_hits, read_pages

HITS = "topic string, rank int, title string, pageid long"


def as_of():
    return F.lit("2024-03-31").cast("date")



def small(spark):
    hits = spark.createDataFrame(
        [
            ("Law", 0, "court", 1),
            ("Law", 1, "missing", 2),
            ("Law", 2, "Court", None),
            ("Law", 3, "judge", 4),
            ("Law", 4, "quiet", 5),
            ("Art", 0, "judge", 4),
        ],
        HITS,
    )
    pages = spark.createDataFrame(
        [("court", "Court"), ("Court", "Court"), ("judge", "Judge"), ("quiet", "Quiet")], "title string, canonical string"
    )
    daily = spark.createDataFrame(
        [
            ("Court", "2024-02-01", 5),
            ("Court", "2024-02-29", None),
            ("Court", "2024-03-01", 100),
            ("Judge", "2024-02-10", 3),
            ("Judge", "2024-02-11", 2),
            ("Judge", "2024-01-31", 100),
        ],
        "title string, day string, views long",
    ).withColumn("day", F.to_date("day"))
    return hits, pages, daily


def test_curate(spark):
    hits, pages, daily = small(spark)
    articles, failed = curate(hits, pages, daily, as_of())
    got = [tuple(r) for r in articles.orderBy("topic", "place").drop("place").collect()]
    # Two hits on one page both stay, ties keep search order, a page without views counts 0.
    assert got == [
        ("Art", 0, "Judge", 4, 5),
        ("Law", 0, "Court", 1, 5),
        ("Law", 2, "Court", None, 5),
        ("Law", 3, "Judge", 4, 5),
        ("Law", 4, "Quiet", 5, 0),
    ]
    assert [tuple(r) for r in failed.collect()] == [("Law", "missing", "Page 'missing' does not exist according to wikipediaapi.")]


def test_ties_at_the_cut_keep_search_order(spark):
    hits, pages, daily = small(spark)
    articles, _ = curate(hits, pages, daily, as_of(), keep=2)
    assert sorted(r["rank"] for r in articles.where("topic = 'Law'").collect()) == [0, 2]


@pytest.mark.parametrize("n", [500, 501])
def test_keeps_at_most_500(spark, n):
    articles = spark.range(n).select(F.lit("t").alias("topic"), F.col("id").alias("rank"), F.lit("x").alias("title"), F.lit(1).alias("views"))
    assert most_viewed(articles.repartition(7)).agg(F.count("*"), F.max("rank")).first() == (500, 499)
    assert cap_hits(articles, 10).agg(F.count("*"), F.max("rank")).first() == (10, 9)


def test_found_and_failed_make_up_the_hits(spark):
    hits, pages, daily = small(spark)
    resolved = resolve_hits(hits, pages, monthly_views(daily, as_of())).cache()
    assert found_articles(resolved).count() + failed_pages(resolved).count() == hits.count()


def test_month_filter_reaches_the_scan(spark, tmp_path):
    small(spark)[2].write.parquet(str(tmp_path / "daily"))
    plan = monthly_views(spark.read.parquet(str(tmp_path / "daily")), as_of())._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(day,2024-02-01)" in plan and "LessThan(day,2024-03-01)" in plan


def test_keyword_search(spark):
    docs = spark.createDataFrame(
        [(1, "Law law Court"), (2, "court LAW"), (3, "law"), (4, "court\tlaw law law"), (5, None), (6, "")], "doc_id long, text string"
    )
    topics = spark.createDataFrame([("a", "court  law"), ("b", "absent law"), ("c", ""), ("d", "Law")], "topic string, query string")
    found = keyword_search(docs, topics, limit=2).orderBy("topic", "rank")
    assert [tuple(r) for r in found.collect()] == [("a", 1, 4, 4), ("a", 2, 1, 3), ("d", 1, 4, 3), ("d", 2, 1, 2)]
    counts = {r["topic"]: r["hits"] for r in hits_per_topic(topics, found).collect()}
    assert counts == {"a": 2, "b": 0, "c": 0, "d": 2}
    assert len(DEFAULT_TOPICS) == 10


@pytest.fixture
def no_broadcast(spark):
    """Joins as they run when neither side is small."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_keyword_search_of_many_copies_equals_brute_force(spark, no_broadcast):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(12))) for _ in range(200)] + ["a b c a"] * 100
    queries = [" ".join(rng.choice("abcdefghz") for _ in range(rng.randrange(1, 4))) for _ in range(25)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    topics = spark.createDataFrame(list(enumerate(queries)), "topic long, query string")
    expected = []
    for topic, query in enumerate(queries):
        terms = set(query.split())
        found = [(-sum(w in terms for w in t.split()), d) for d, t in enumerate(texts) if terms <= set(t.split())]
        expected += [(topic, place, d, -hits) for place, (hits, d) in enumerate(sorted(found)[:30], 1)]
    assert sorted(tuple(r) for r in keyword_search(docs, topics, limit=30).collect()) == expected


def test_a_title_with_a_third_of_all_hits(spark, no_broadcast):
    rows = [(f"t{i % 3}", i, "hot" if i % 3 == 0 else f"p{i % 40}", i) for i in range(3000)]
    hits = spark.createDataFrame(rows, HITS).repartition(5)
    pages = spark.createDataFrame([("hot", "Hot"), *[(f"p{i}", f"P{i}") for i in range(0, 40, 2)]], "title string, canonical string")
    views = spark.createDataFrame([("Hot", 7), ("P4", 1)], "title string, views long")
    resolved = resolve_hits(hits, pages, views)
    known = {"Hot": 7, "P4": 1}
    expected = []
    for topic, rank, title, pageid in rows:
        canonical = title.capitalize() if title == "hot" or int(title[1:]) % 2 == 0 else None
        expected.append((topic, rank, title, pageid, canonical, known.get(canonical, 0)))
    assert sorted((tuple(r) for r in resolved.collect()), key=lambda r: r[1]) == expected
    kept = [tuple(r) for r in most_viewed(found_articles(resolved), 4).drop("place").orderBy("topic", "rank").collect()]
    best = {}
    for topic, rank, _, pageid, canonical, seen in sorted(expected, key=lambda r: (-r[5], r[1])):
        if canonical:
            best.setdefault(topic, []).append((topic, rank, canonical, pageid, seen))
    assert kept == sorted(row for rows in best.values() for row in rows[:4])


def test_ranked_lists_on_disk(spark, tmp_path):
    rows = [("Computer science", 1, "Çok", 7, 9), ("Computer science", 0, "B", None, 9), ("2024", 0, "C", 1, 0)]
    articles = spark.createDataFrame(rows, "topic string, place int, title string, pageid long, views long")
    path = str(tmp_path / "ranked")
    for _ in range(2):
        write_ranked_lists(articles, path)
    got = sorted(tuple(r) for r in read_ranked_lists(spark, path).select("topic", "title", "pageid", "views").collect())
    assert got == [("2024", "C", 1, 0), ("Computer science", "B", None, 9), ("Computer science", "Çok", 7, 9)]
    text = "".join(f.read_text(encoding="utf-8") for f in (tmp_path / "ranked").glob("topic=Computer*/*.json"))
    assert [json.loads(line) for line in text.splitlines()] == [
        {"title": "B", "pageid": None, "views": 9, "place": 0},
        {"title": "Çok", "pageid": 7, "views": 9, "place": 1},
    ]
    assert "Çok" in text
    write_failed_pages(spark.createDataFrame([("t", "x", "e")], "topic string, original_title string, error string"), str(tmp_path / "failed"))
    assert spark.read.json(str(tmp_path / "failed")).first().asDict() == {"original_title": "x", "error": "e", "topic": "t"}


def test_ranked_arrays(spark, tmp_path):
    entries = [{"title": "Çok", "pageid": None, "views": 3}, {"title": "B", "pageid": 4, "views": 1}]
    (tmp_path / "Computer_science_articles.json").write_text(json.dumps(entries, ensure_ascii=False, indent=4), encoding="utf-8")
    (tmp_path / "Computer_science_failed_pages.json").write_text("[]")
    got = read_ranked_arrays(spark, str(tmp_path)).orderBy("place").collect()
    assert [tuple(r) for r in got] == [("Computer science", 1, "Çok", None, 3), ("Computer science", 2, "B", 4, 1)]
    assert got[0].asDict().keys() == {"topic", "place", "title", "pageid", "views"}


def test_article_files(spark, tmp_path):
    for folder, name, data in [
        ("Law", "a.txt", "çok\r\nline".encode()),
        ("Art", "a.txt", b""),
        ("Art", "bad.txt", b"\xff\xfe"),
        ("Art", "b.TXT", b"no"),
        ("Art", "c.md", b"no"),
        ("Art/deep", "d.txt", b"no"),
        (".", "top.txt", b"no"),
    ]:
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / folder / name).write_bytes(data)
    (tmp_path / "Law" / ".NET.txt").write_text("x")
    (tmp_path / "_Odd").mkdir()
    (tmp_path / "_Odd" / "_a 100%.txt").write_text("a\rb")
    (tmp_path / "Art" / "folder.txt").mkdir()
    read = read_article_files(spark, str(tmp_path)).collect()
    assert sorted(r[:3] for r in read) == [
        ("Art", "a.txt", ""), ("Art", "bad.txt", ""), ("Art", "folder.txt", ""), ("Law", ".NET.txt", "x"), ("Law", "a.txt", "çok\nline"), ("_Odd", "_a 100%.txt", "a\nb"),
    ]
    assert {r.file_name for r in read if r.error} == {"bad.txt", "folder.txt"}
    (tmp_path / "none").mkdir()
    assert read_article_files(spark, f"file:{tmp_path}/none").count() == 0
    with pytest.raises(Exception, match="FileNotFoundError"):
        read_article_files(spark, str(tmp_path / "absent")).count()
    texts = spark.createDataFrame([("t", "x"), ("t", "y"), ("u", "z")], "topic string, content string")
    write_article_files(texts, str(tmp_path / "out"))
    again = read_article_files(spark, str(tmp_path / "out")).where("file_name like 'part-%'").select("topic", "text").collect()
    assert sorted(tuple(r) for r in again) == [("topic=t", "x\n"), ("topic=t", "y\n"), ("topic=u", "z\n")]


def test_named_files(spark, tmp_path):
    texts = spark.createDataFrame([("Big Law", ".a", "x"), ("Big Law", "b%", None), ("Art", "çok", "é" * 9)], "topic string, safe_title string, content string")
    for _ in range(2):
        write_named_files(texts, str(tmp_path))
    found = {(r.topic, r.file_name): r.text for r in read_article_files(spark, str(tmp_path), tasks=2).collect()}
    assert found == {("BigLaw", ".a.txt"): "x", ("BigLaw", "b%.txt"): "", ("Art", "çok.txt"): "é" * 9}
    assert len(list(tmp_path.rglob("*"))) == 5


def test_last_of_equal_safe_titles_stays(spark):
    articles = spark.createDataFrame([("t", 1, "a/b"), ("t", 2, "a:b"), ("u", 1, "a/b"), ("u", 2, "none")], "topic string, place int, title string")
    contents = spark.createDataFrame([("a/b", "first"), ("a:b", "second")], "title string, content string")
    got = safe_articles(article_texts(articles, contents)).collect()
    assert sorted(tuple(r) for r in got) == [("t", "ab", "second"), ("u", "ab", "first")]


def test_landed_files(spark, tmp_path):
    (tmp_path / "hits").mkdir()
    (tmp_path / "hits" / "h.json").write_text('{"topic":"t","rank":0,"title":"a","pageid":3}\n{"topic":"t","rank":1,"title":"b"}\n')
    assert [tuple(r) for r in read_hits(spark, str(tmp_path / "hits")).orderBy("rank").collect()] == [("t", 0, "a", 3), ("t", 1, "b", None)]
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "p.json").write_text('{"title":"a","canonical":"A"}\n')
    assert read_pages(spark, str(tmp_path / "pages")).first() == ("a", "A")
    responses = spark.createDataFrame([("a", '{"items":[{"views":3},{"x":1}]}'), ("b", "{}")], "title string, payload string")
    assert [tuple(r) for r in daily_views_of_json(responses, "payload", "title").collect()] == [("a", 3), ("a", None)]


def test_curate_and_extract_jobs(spark, tmp_path):
    hits, pages, daily = small(spark)
    curate_job(hits, pages, daily, as_of(), str(tmp_path), keep=3)
    ranked = read_ranked_lists(spark, str(tmp_path / "articles"))
    assert ranked.where("topic = 'Law'").count() == 3
    assert spark.read.json(str(tmp_path / "failed")).count() == 1
    trees = spark.createDataFrame([(1, "Court", "Lead."), (2, "Judge", None), (3, "Other", "x")], "page_id long, title string, summary string")
    sections = spark.createDataFrame(
        [(1, 0, 1, "Past", "Old. Older."), (1, 1, 1, "Notes", "n"), (1, 2, 2, "Sub", "n"), (2, 0, 1, "", "Robe.")],
        "page_id long, ord long, level int, title string, text string",
    )
    extract_job(ranked, trees, sections, str(tmp_path / "texts"))
    got = spark.read.parquet(str(tmp_path / "texts")).select("topic", "safe_title", "content").collect()
    court, judge = "Court\nLead.\nPast\nOld.\nOlder.", "Judge\nRobe."
    assert sorted(tuple(r) for r in got) == [("Art", "Judge", judge), ("Law", "Court", court), ("Law", "Judge", judge)]


def test_jobs_chain(spark, tmp_path):
    hits, pages, daily = small(spark)
    curate_job(hits, pages, daily, as_of(), str(tmp_path / "curated"))
    ranked = read_ranked_lists(spark, str(tmp_path / "curated" / "articles"))
    trees = spark.createDataFrame([(1, "Court", "Lead. More."), (2, "Judge", "Robe.")], "page_id long, title string, summary string")
    sections = spark.createDataFrame([], "page_id long, ord long, level int, title string, text string")
    extract_job(ranked, trees, sections, str(tmp_path / "texts"))
    report = index_job(spark, str(tmp_path / "texts"), str(tmp_path / "index"))
    assert report.agg(F.sum("objects")).first()[0] == ranked.where("title in ('Court', 'Judge')").select("topic", "title").distinct().count()
    found = ask(read_index(spark, str(tmp_path / "index")), ["topic", "file_name", "chunk_ix"], "robe")
    assert found["rag_text"] and "Robe." in found["rag_text"][0]


def test_more_than_the_default_window_limit_is_cut_before_the_shuffle(spark):
    articles = spark.range(5000).repartition(4).selectExpr("'t' AS topic", "id AS rank", "'x' AS title", "id AS pageid", "id AS views")
    plan = most_viewed(articles, 1001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_failed_lookups_and_unfetched_articles(spark, tmp_path):
    hits, pages, daily = small(spark)
    pages = pages.withColumn("error", F.lit(None).cast("string")).unionByName(
        spark.createDataFrame([("missing", None, "timed out")], "title string, canonical string, error string")
    )
    articles, failed = curate(hits.unionByName(spark.createDataFrame([("Law", 9, "gone", 1)], HITS)), pages, daily, as_of())
    assert articles.count() == 5
    assert {r.original_title: r.error for r in failed.collect()} == {
        "missing": "Error retrieving page for 'missing': timed out",
        "gone": "Page 'gone' does not exist according to wikipediaapi.",
    }
    missing = unfetched_articles(articles, spark.createDataFrame([("Court",), ("Judge",)], "title string"))
    assert [tuple(r) for r in missing.collect()] == [("Law", "Quiet", "Page 'Quiet' does not exist or could not be fetched.")]


def test_only_wanted_views_are_summed(spark, tmp_path):
    hits, pages, daily = small(spark)
    daily = daily.unionByName(spark.createDataFrame([(f"Other {i}", 7) for i in range(500)], "title string, views long").withColumn("day", F.to_date(F.lit("2024-02-05"))))
    daily.write.parquet(str(tmp_path / "daily"))
    daily = spark.read.parquet(str(tmp_path / "daily"))
    views = monthly_views(daily, as_of(), wanted=wanted_titles(hits, pages))
    assert {tuple(r) for r in views.collect()} == {("Court", 5), ("Judge", 5)}
    plan = views._jdf.queryExecution().optimizedPlan().toString().splitlines()
    # The semi-join stands below the sum, right above the scan of the month.
    place = {what: next(i for i, line in enumerate(plan) if what in line) for what in ("sum(", "Join LeftSemi", "day#")}
    assert place["sum("] < place["Join LeftSemi"] < place["day#"]
