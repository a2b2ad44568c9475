"""Article texts of a curated list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import clean_file_name, unfetched_error
from corpusloom.operators.sections import page_content, page_lines


def page_texts(pages: DataFrame, title: Column, summary: Column, sections: Column, *keep: str) -> DataFrame:
    """Content of pages held one per row; a narrow job."""
    return pages.select(*keep, title.alias("title"), page_content(page_lines(title, summary, sections)).alias("content"))


def article_texts(articles: DataFrame, contents: DataFrame) -> DataFrame:
    """Content of every listed article that has a page: ``topic, place, title, content``. The others
    are given by ``unfetched_articles``."""
    return articles.join(contents, "title").select("topic", "place", "title", "content")


def unfetched_articles(articles: DataFrame, pages: DataFrame) -> DataFrame:
    """Listed articles without a page among ``pages (title)``: ``topic, original_title, error``."""
    missing = articles.join(pages.select("title"), "title", "left_anti")
    return missing.select("topic", F.col("title").alias("original_title"), unfetched_error(F.col("title")).alias("error"))


def safe_articles(texts: DataFrame, order: str = "place") -> DataFrame:
    """One text per topic and safe title; of titles that clean to the same name the last one
    in the order of the topic's list stays.

    The choice is an aggregate, so a name held by many rows is reduced in every task first.
    """
    named = texts.withColumn("safe_title", clean_file_name(F.col("title")))
    return named.groupBy("topic", "safe_title").agg(F.max_by("content", order).alias("content"))
