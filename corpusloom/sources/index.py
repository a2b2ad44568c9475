"""Reading the chunk index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.shards import REJECT_SHARD


def read_index(spark: SparkSession, path: str, shards: list[int] | None = None) -> DataFrame:
    """Indexed chunks; ``shards`` reads only those partitions."""
    index = spark.read.parquet(path)
    wanted = F.col("shard") != REJECT_SHARD if shards is None else F.col("shard").isin(*shards)
    return index.where(wanted)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("shard") == REJECT_SHARD)
