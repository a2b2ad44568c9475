"""Topic curation: search hits to the most viewed articles and the failed pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.dates import in_last_month
from corpusloom.functions.text import missing_page_error, retrieval_error
from corpusloom.operators.ranking import top_per_group
from corpusloom.operators.search import HITS_PER_TOPIC

# --- fixed values -------------------------------------------------------------------------------
ARTICLES_PER_TOPIC = 500
# ------------------------------------------------------------------------------------------------


def monthly_views(
    daily: DataFrame, as_of: Column, title: str = "title", day: str = "day", views: str = "views", wanted: DataFrame | None = None
) -> DataFrame:
    """Views per title over the last complete month; a missing count is 0.

    The month is a bare-column range, so it prunes the scan, and titles are pre-summed in every
    task before the shuffle. With ``wanted (title)`` only those titles are summed: the daily rows are
    reduced by a semi-join first, which Spark does by broadcast where the titles are few, and
    where they are many with a Bloom filter on the scan (its runtime filter for large scans).
    """
    month = daily.where(in_last_month(F.col(day), as_of))
    if wanted is not None:
        month = month.join(wanted.select(F.col("title").alias(title)), title, "left_semi")
    return month.groupBy(title).agg(F.sum(F.coalesce(F.col(views), F.lit(0))).cast("bigint").alias("views"))


def cap_hits(hits: DataFrame, limit: int = HITS_PER_TOPIC) -> DataFrame:
    """The first ``limit`` search hits of every topic."""
    return top_per_group(hits, ["topic"], [F.asc("rank")], limit)


def wanted_titles(hits: DataFrame, pages: DataFrame) -> DataFrame:
    """Titles of the pages that the hits lead to, of which there are no more than hits."""
    led_to = pages.where("canonical is not null").join(hits.select("title"), "title", "left_semi")
    return led_to.select(F.col("canonical").alias("title")).distinct()


def resolve_hits(hits: DataFrame, pages: DataFrame, views: DataFrame) -> DataFrame:
    """Every hit with its page's canonical title (null where no page exists) and views.

    ``pages (title, canonical)`` and ``views (title, views)`` hold one row per title. A page whose
    lookup failed may be in ``pages`` with a null canonical title and an ``error``, which is then handed
    on. The two are joined to each other first, so the hits are shuffled once however many lookups they
    need. Two hits on one page both stay. Views not found are 0.
    """
    page_views = pages.join(views.withColumnRenamed("title", "canonical"), "canonical", "left")
    error = ["error"] if "error" in pages.columns else []
    return hits.join(page_views, "title", "left").select(
        "topic", "rank", "title", "pageid", "canonical", F.coalesce("views", F.lit(0)).alias("views"), *error
    )


def found_articles(resolved: DataFrame) -> DataFrame:
    found = resolved.where("canonical is not null")
    return found.select("topic", "rank", F.col("canonical").alias("title"), "pageid", "views")


def failed_pages(resolved: DataFrame) -> DataFrame:
    """Hits without a page, with the error text: that of the lookup if it failed."""
    missing, title = resolved.where("canonical is null"), F.col("title")
    error = missing_page_error(title)
    if "error" in resolved.columns:
        error = F.coalesce(retrieval_error(title, F.col("error")), error)
    return missing.select("topic", title.alias("original_title"), error.alias("error"))


def most_viewed(articles: DataFrame, keep: int = ARTICLES_PER_TOPIC) -> DataFrame:
    """The most viewed articles of every topic with their ``place`` in the list, from 1; among equals
    the earlier search hit comes first."""
    return top_per_group(articles, ["topic"], [F.desc("views"), F.asc("rank")], keep, rank="place")


def curate(
    hits: DataFrame,
    pages: DataFrame,
    daily: DataFrame,
    as_of: Column,
    limit: int = HITS_PER_TOPIC,
    keep: int = ARTICLES_PER_TOPIC,
) -> tuple[DataFrame, DataFrame]:
    """Ranked articles and failed pages of all topics. Only the views of capped hits are summed."""
    capped = cap_hits(hits, limit)
    resolved = resolve_hits(capped, pages, monthly_views(daily, as_of, wanted=wanted_titles(capped, pages)))
    return most_viewed(found_articles(resolved), keep), failed_pages(resolved)
