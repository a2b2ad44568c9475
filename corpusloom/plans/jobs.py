"""The three batch jobs from path to path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.vectors import Embedder
from corpusloom.operators.sections import assemble_content, explode_section_lines, keep_sections, page_lines
from corpusloom.operators.shards import shard_report
from corpusloom.plans.curate import (
    ARTICLES_PER_TOPIC,
    HITS_PER_TOPIC,
    cap_hits,
    failed_pages,
    found_articles,
    monthly_views,
    most_viewed,
    resolve_hits,
    wanted_titles,
)
from corpusloom.plans.extract import article_texts, safe_articles, unfetched_articles
from corpusloom.plans.indexing import index_objects
from corpusloom.session import spread, work_folder
from corpusloom.sinks.articles import write_article_texts, write_failed_pages, write_ranked_lists
from corpusloom.sinks.index import write_index
from corpusloom.sources.articles import read_article_files, read_article_texts
from corpusloom.sources.index import read_index

FILE_KEYS = ["topic", "file_name"]


def curate_job(
    hits: DataFrame,
    pages: DataFrame,
    daily: DataFrame,
    as_of: Column,
    out: str,
    limit: int = HITS_PER_TOPIC,
    keep: int = ARTICLES_PER_TOPIC,
) -> None:
    """Ranked articles under ``<out>/articles`` and failed pages under ``<out>/failed``.

    The capped hits, at most ``limit`` per topic, are stored first, as they tell which views are
    wanted, and so are the resolved ones, so that views are read and summed once for both outputs.
    """
    spark = hits.sparkSession
    capped = work_folder(spark, "capped")
    cap_hits(hits, limit).write.parquet(capped)
    capped = spark.read.parquet(capped)
    path = work_folder(spark, "resolved")
    resolve_hits(capped, pages, monthly_views(daily, as_of, wanted=wanted_titles(capped, pages))).write.parquet(path)
    resolved = spark.read.parquet(path)
    write_ranked_lists(most_viewed(found_articles(resolved), keep), f"{out}/articles")
    write_failed_pages(failed_pages(resolved), f"{out}/failed")


def page_lines_by_row(pages: DataFrame, sections: DataFrame) -> DataFrame:
    """Lines of page trees held as rows: ``pages (page_id, title, summary)`` and their
    ``sections (page_id, ord, level, title, text)``, ``ord`` from 0."""
    # A page's own lines come before those of its first section.
    head = page_lines(F.col("title"), F.col("summary"), F.lit(None))
    heads = pages.select("page_id", F.lit(-1).cast("bigint").alias("ord"), F.posexplode(head).alias("line_ix", "line"))
    return heads.unionByName(explode_section_lines(keep_sections(sections)))


def extract_job(articles: DataFrame, pages: DataFrame, sections: DataFrame, out: str, failed: str | None = None) -> None:
    """Texts of the listed articles ``(topic, place, title)``, as ``read_ranked_lists`` gives them, as a
    table in folders per topic. Only the listed pages' sections are looked at. Articles without a page
    are written to ``failed``, if that is given, with an error text."""
    if failed:
        write_failed_pages(unfetched_articles(articles, pages), failed)
    listed = pages.join(articles.select("title"), "title", "left_semi")
    their_sections = sections.join(listed.select("page_id"), "page_id", "left_semi")
    contents = assemble_content(page_lines_by_row(listed, their_sections)).join(listed.select("page_id", "title"), "page_id")
    write_article_texts(safe_articles(article_texts(articles, contents.select("title", "content"))), out)


def index_job(spark: SparkSession, articles: str, out: str, embed: Embedder | None = None, files: bool = False, **options) -> DataFrame:
    """Index of the texts that ``extract_job`` has written to ``articles``, or of the text files
    below it; returns the report of the written shards."""
    texts = read_article_files(spark, articles) if files else read_article_texts(spark, articles)
    write_index(index_objects(spread(texts, *FILE_KEYS), FILE_KEYS, embed=embed, **options), out)
    return shard_report(read_index(spark, out))
