"""Daily view counts held as JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAILY_VIEWS_SCHEMA = "items array<struct<views:bigint>>"


def views_of_json(payload: Column) -> Column:
    """Sum of ``items[].views``; a missing list and a missing field both count as 0."""
    items = F.from_json(payload, DAILY_VIEWS_SCHEMA)["items"]
    items = F.coalesce(items, F.array().cast("array<struct<views:bigint>>"))
    return F.aggregate(
        items, F.lit(0).cast("bigint"), lambda total, item: total + F.coalesce(item["views"], F.lit(0))
    )
