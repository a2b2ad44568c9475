"""The reporting month."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_FORMAT = "yyyyMMdd"


def last_month_start(as_of: Column) -> Column:
    return F.add_months(F.trunc(as_of, "month"), -1)


def last_month_end(as_of: Column) -> Column:
    return F.date_sub(F.trunc(as_of, "month"), 1)


def last_month_range(as_of: Column) -> tuple[Column, Column]:
    """First and last day of the last complete month before ``as_of``, as ``yyyyMMdd`` text."""
    return (
        F.date_format(last_month_start(as_of), DAY_FORMAT),
        F.date_format(last_month_end(as_of), DAY_FORMAT),
    )


def in_last_month(day: Column, as_of: Column) -> Column:
    """Half-open test on the bare column, so that it reaches the scan for dates and timestamps."""
    return (day >= last_month_start(as_of)) & (day < F.trunc(as_of, "month"))
