"""Landed web data: search hits, pages and daily views that were fetched before the job runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.views import DAILY_VIEWS_SCHEMA

HITS_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("pageid", T.LongType()),
    ]
)
PAGES_SCHEMA = "title string, canonical string"
SECTIONS_SCHEMA = "page_id bigint, ord bigint, level int, title string, text string"


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """Search hits as JSON lines; an absent page id is null."""
    return spark.read.schema(HITS_SCHEMA).json(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Known titles with the title of the page they lead to."""
    return spark.read.schema(PAGES_SCHEMA).json(path)


def read_sections(spark: SparkSession, path: str) -> DataFrame:
    """Sections of page trees, one row each in reading order."""
    return spark.read.schema(SECTIONS_SCHEMA).parquet(path)


def daily_views_of_json(responses: DataFrame, payload: str = "payload", *keep: str) -> DataFrame:
    """Daily view rows of JSON responses ``{"items": [{"views": n}]}``; a missing count is null."""
    items: Column = F.from_json(F.col(payload), DAILY_VIEWS_SCHEMA)["items"]
    return responses.select(*keep, F.explode(items).alias("_item")).select(*keep, "_item.views")
