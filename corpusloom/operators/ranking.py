"""Best rows per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_SALTS = 64


def top_per_group(
    df: DataFrame,
    group: list[str],
    order: list[Column],
    n: int,
    rank: str | None = None,
    salts: int = DEFAULT_SALTS,
) -> DataFrame:
    """The first ``n`` rows of each group in a total ``order``; ``rank`` names the position column.

    Two rounds, so that a group holding a third of all rows is no single task's work: the rows of
    every map task are cut to ``n`` per group before they are shuffled, groups are then split by
    the map task's number, and only ``salts * n`` rows per group are left for the last round. The
    order must be total, which makes the result independent of the split.
    """
    salted = df.withColumn("_salt", F.spark_partition_id() % salts)
    first = Window.partitionBy(*group, "_salt").orderBy(*order)
    survivors = salted.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= n)
    last = Window.partitionBy(*group).orderBy(*order)
    ranked = survivors.drop("_rank", "_salt").withColumn("_rank", F.row_number().over(last)).where(F.col("_rank") <= n)
    return ranked.withColumnRenamed("_rank", rank) if rank else ranked.drop("_rank")


def numbered_rows(df: DataFrame, group: list[str], seq: str, name: str, block: int = 100_000) -> DataFrame:
    """Position of each row in its group (from 1) by the integer column ``seq``, unique per group.

    Rows are numbered within blocks of ``seq``, and each block starts after the rows of the blocks
    before it, so the largest unit of work is one block and never a whole group.
    """
    blocks = df.withColumn("_block", F.floor(F.col(seq) / block))
    within = Window.partitionBy(*group, "_block").orderBy(seq)
    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        blocks.groupBy(*group, "_block")
        .agg(F.count("*").alias("_rows"))
        .select(*group, "_block", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    numbered = blocks.withColumn("_position", F.row_number().over(within))
    return (
        numbered.join(offsets, [*group, "_block"])
        .withColumn(name, F.col("_position") + F.col("_offset"))
        .drop("_block", "_position", "_offset")
    )
