"""Topic curation and keyword search."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog import sql
from corpusloom.catalog.tables import as_of, daily_views, documents, hits, known_pages, search_topics, table
from corpusloom.operators.postings import build_postings, document_frequencies, read_postings, search_postings, write_postings
from corpusloom.operators.search import HITS_PER_TOPIC, hits_per_topic, keyword_search as search
from corpusloom.plans.curate import cap_hits, curate, monthly_views, resolve_hits, wanted_titles
from corpusloom.plans.extract import unfetched_articles as without_page
from corpusloom.session import work_folder
from corpusloom.sinks.articles import write_failed_pages, write_ranked_arrays, write_ranked_lists
from corpusloom.sources.articles import read_ranked_arrays, read_ranked_lists


def _curated(spark, sf_dir):
    return curate(hits(spark, sf_dir), known_pages(spark, sf_dir), daily_views(spark, sf_dir), as_of())


def last_month_views(spark, sf_dir):
    """Shipped quantity per part in the last complete month, as views."""
    lines = table(spark, sf_dir, "lineitem")
    return monthly_views(lines, as_of(), title="l_partkey", day="l_shipdate", views="l_quantity")


def resolved_hits(spark, sf_dir):
    capped, pages = cap_hits(hits(spark, sf_dir)), known_pages(spark, sf_dir)
    views = monthly_views(daily_views(spark, sf_dir), as_of(), wanted=wanted_titles(capped, pages))
    return resolve_hits(capped, pages, views)


def top_articles_per_topic(spark, sf_dir):
    return _curated(spark, sf_dir)[0]


def failed_pages(spark, sf_dir):
    return _curated(spark, sf_dir)[1]


def ranked_lists(spark, sf_dir):
    """The ranked articles as written to JSON and read back."""
    path = work_folder(spark, "ranked")
    write_ranked_lists(_curated(spark, sf_dir)[0], path)
    return read_ranked_lists(spark, path)


def ranked_arrays(spark, sf_dir):
    """The ranked articles as one JSON array per topic, written and read back."""
    path = work_folder(spark, "ranked-arrays")
    write_ranked_arrays(_curated(spark, sf_dir)[0], path)
    return read_ranked_arrays(spark, path)


def failed_lists(spark, sf_dir):
    path = work_folder(spark, "failed")
    write_failed_pages(_curated(spark, sf_dir)[1], path)
    return spark.read.schema("original_title string, error string, topic string").json(path)


def article_counts(spark, sf_dir):
    return _curated(spark, sf_dir)[0].groupBy("topic").agg(F.count("*").alias("articles"))


def unfetched_articles(spark, sf_dir):
    """Listed articles that have no page when their texts are extracted: here those of even size."""
    articles = _curated(spark, sf_dir)[0]
    fetched = known_pages(spark, sf_dir).select(F.col("canonical").alias("title"))
    return without_page(articles, fetched.where(F.regexp_extract("title", r"(\d+)$", 1).try_cast("int") % 2 == 1))


def _found(spark, sf_dir):
    return search(documents(spark, sf_dir), search_topics(spark, sf_dir), limit=HITS_PER_TOPIC)


def _stored_postings(spark, sf_dir):
    path = work_folder(spark, "postings")
    write_postings(build_postings(documents(spark, sf_dir)), path)
    return read_postings(spark, path)


def keyword_search(spark, sf_dir):
    """The best documents of every topic, from a stored inverted index."""
    found = search_postings(_stored_postings(spark, sf_dir), search_topics(spark, sf_dir), limit=HITS_PER_TOPIC)
    return found.withColumn("rank", F.col("rank").cast("bigint"))


def term_frequencies(spark, sf_dir):
    """In how many documents each word occurs, from the index without its postings."""
    return document_frequencies(_stored_postings(spark, sf_dir))


def keyword_hit_counts(spark, sf_dir):
    return hits_per_topic(search_topics(spark, sf_dir), _found(spark, sf_dir))


QUERIES = {
    "last_month_views": last_month_views,
    "resolved_hits": resolved_hits,
    "top_articles_per_topic": top_articles_per_topic,
    "failed_pages": failed_pages,
    "ranked_lists": ranked_lists,
    "ranked_arrays": ranked_arrays,
    "failed_lists": failed_lists,
    "article_counts": article_counts,
    "keyword_search": keyword_search,
    "keyword_hit_counts": keyword_hit_counts,
    "term_frequencies": term_frequencies,
    "unfetched_articles": unfetched_articles,
}

# The error texts.
_FAILED = f"""
    WITH {sql.RESOLVED}
    SELECT topic, title AS original_title,
      CASE WHEN error IS NOT NULL THEN 'Error retrieving page for ''' || title || ''': ' || error
           ELSE 'Page ''' || title || ''' does not exist according to wikipediaapi.' END AS error
    FROM resolved WHERE canonical IS NULL"""

ORACLE = {
    "last_month_views": """
        SELECT l_partkey, sum(l_quantity)::BIGINT AS views FROM lineitem
        WHERE l_shipdate >= DATE '1998-06-01' AND l_shipdate < DATE '1998-07-01' GROUP BY l_partkey""",
    "resolved_hits": f"WITH {sql.RESOLVED} SELECT topic, rank, title, pageid, canonical, views, error FROM resolved",
    "top_articles_per_topic": f"WITH {sql.RESOLVED} SELECT topic, rank, title, pageid, views, place FROM articles",
    "failed_pages": _FAILED,
    "ranked_lists": f"WITH {sql.RESOLVED} SELECT topic, title, pageid, views, place FROM articles",
    "ranked_arrays": f"WITH {sql.RESOLVED} SELECT topic, place, title, pageid, views FROM articles",
    "failed_lists": _FAILED,
    "article_counts": f"WITH {sql.RESOLVED} SELECT topic, count(*) AS articles FROM articles GROUP BY topic",
    "keyword_search": f"WITH {sql.SEARCH} SELECT topic, rank, doc_id, hits FROM hits",
    "unfetched_articles": f"""
        WITH {sql.RESOLVED}
        SELECT topic, title AS original_title, 'Page ''' || title || ''' does not exist or could not be fetched.' AS error
        FROM articles WHERE regexp_extract(title, '([0-9]+)$', 1)::INTEGER % 2 = 0""",
    "term_frequencies": f"WITH {sql.SEARCH} SELECT term, count(*) AS docs FROM held GROUP BY term",
    "keyword_hit_counts": f"""
        WITH {sql.SEARCH} SELECT item_id AS topic, count(doc_id) AS hits FROM benchmark LEFT JOIN hits ON topic = item_id GROUP BY item_id""",
}
