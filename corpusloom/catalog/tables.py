"""The given tables, and the landed tables derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import split_words
from corpusloom.session import spread

AS_OF = "1998-07-15"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arriving(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table's files as a stream. The table may be one file or a folder of them, and a stream takes a
    file by a pattern only, which the last letter in brackets makes of its name."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def documents(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", *extra), "doc_id")


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users' turns, as ``conv_id, seq, query``."""
    turns = table(spark, sf_dir, "conversations").where("role = 'user'")
    return turns.select("conv_id", F.col("turn").alias("seq"), F.col("text").alias("query"))


def as_of() -> Column:
    return F.lit(AS_OF).cast("date")


def _part_title() -> Column:
    return F.concat_ws(" ", "p_name", "p_type", F.col("p_size").cast("string"))


def _canonical(title: Column) -> Column:
    return F.concat(F.upper(F.substring(title, 1, 1)), F.expr("substring(title, 2)"))


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as search hits: the type is the topic, the key the rank."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_type").alias("topic"), F.col("p_partkey").alias("rank"), _part_title().alias("title"), F.col("p_partkey").alias("pageid")
    )


SMALLEST_WITH_PAGE, LARGEST_TIMED_OUT = 11, 5  # sizes run from 1 to 50


def known_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of parts with the page title they lead to. The smaller parts' lookups fail: the
    smallest with an error, others have no page. The size is a part of the title, so all parts of
    one title fare alike."""
    part = table(spark, sf_dir, "part").select(_part_title().alias("title"), "p_size").distinct()
    error = F.when(F.col("p_size") <= LARGEST_TIMED_OUT, F.lit("timed out"))
    canonical = F.when(F.col("p_size") >= SMALLEST_WITH_PAGE, _canonical(F.col("title")))
    return part.select("title", canonical.alias("canonical"), error.alias("error")).where("canonical is not null or error is not null")


def daily_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipped quantities as daily views of the part's page."""
    part = table(spark, sf_dir, "part").select("p_partkey", _part_title().alias("title"))
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", F.col("l_shipdate").alias("day"), F.col("l_quantity").alias("views"))
    named = part.join(lines, part.p_partkey == lines.l_partkey)
    return named.select(_canonical(F.col("title")).alias("title"), "day", "views")


def search_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("topic"), F.col("text").alias("query"))


def page_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title, lead paragraph and further paragraphs (as sections) of the raw web pages. Headings
    and levels, which the pages lack, are given by a paragraph's place."""
    pages = spread(table(spark, sf_dir, "pages"), "page_id")
    body = F.regexp_extract("html", r"(?s)<article>(.*?)</article>", 1)
    paragraphs = F.transform(F.split(body, "<p>"), lambda p: F.regexp_replace(p, "<[^>]*>", ""))
    parts = pages.select(
        "page_id", "url", F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1).alias("title"), paragraphs.alias("_all")
    )
    heading = lambda i: F.when(i % 4 == 2, " See Also ").when(i % 3 == 0, "").otherwise(F.concat(F.lit("Part "), i.cast("string")))
    sections = F.transform(
        F.slice("_all", 3, F.greatest(F.size("_all") - 2, F.lit(0))),
        lambda p, i: F.struct((i % 3 + 1).alias("level"), heading(i).alias("title"), p.alias("text")),
    )
    return parts.select("page_id", "url", "title", F.get("_all", F.lit(1)).alias("summary"), sections.alias("sections"))


def paragraph_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' paragraphs as section rows; level and heading follow from their lengths."""
    docs = documents(spark, sf_dir)
    lines = docs.select(F.col("doc_id").alias("page_id"), F.posexplode(F.split("text", "\n")).alias("ord", "text"))
    n_words, n_chars = F.size(split_words(F.col("text"))), F.length("text")
    title = F.when(n_words % 7 == 3, " See Also ").when(n_words % 7 == 5, "REFERENCES").when(n_words % 7 == 1, "")
    return lines.select(
        "page_id",
        F.col("ord").cast("bigint").alias("ord"),
        (n_chars % 4 + 1).alias("level"),
        title.otherwise(F.concat(F.lit("Part "), F.col("ord").cast("string"))).alias("title"),
        "text",
    )
