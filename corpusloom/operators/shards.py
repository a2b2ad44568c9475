"""Shards as data: routing rows, and the registry of shard names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import shard_of_name

# --- fixed values -------------------------------------------------------------------------------
DEFAULT_SHARDS = 5
INSERT_BATCH = 100
GATEWAY_NAME = "grpc"
# ------------------------------------------------------------------------------------------------
REJECT_SHARD = -1

REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("ip", T.StringType()),
        T.StructField("port", T.StringType()),
        T.StructField("query", T.StringType()),
    ]
)


def shard_of(keys: list[str], shards: int = DEFAULT_SHARDS) -> Column:
    """Shard by the row's key, so that a rerun places every row alike."""
    digest = F.md5(F.concat_ws("/", *[F.col(k).cast("string") for k in keys]))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(shards)).cast("int")


def rendezvous_shard(keys: list[str], shards: int = DEFAULT_SHARDS) -> Column:
    """Shard of highest weight for the row's key, a weight being the digest of key and shard.

    Another shard takes only the rows for which its weight is the highest, about one in
    ``shards + 1``, and every other row stays where it is. Ties go to the lower shard.
    """
    key = F.concat_ws("/", *[F.col(k).cast("string") for k in keys])
    weight = lambda s: F.struct(F.md5(F.concat(F.lit(f"{s}/"), key)).alias("weight"), F.lit(-s).alias("shard"))
    return (-F.greatest(*[weight(s) for s in range(shards)])["shard"] if shards > 1 else F.lit(0)).cast("int")


def registry(spark: SparkSession, services: list[dict]) -> DataFrame:
    """Service entries under the fixed schema: extra keys are ignored, missing ones are null."""
    rows = [tuple(str(s[f]) if s.get(f) is not None else None for f in REGISTRY_SCHEMA.names) for s in services]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def shard_registry(names: DataFrame, name: str = "name", gateway: str = GATEWAY_NAME) -> DataFrame:
    """Shard number of every registry entry but the gateway."""
    return names.where(F.col(name) != gateway).withColumn("shard", shard_of_name(F.col(name)))


def pose_question(shards: DataFrame, question: str, column: str = "query") -> DataFrame:
    """The registry with one question in every row, whatever its column held before."""
    return shards.withColumn(column, F.lit(question).cast("string"))


def ask_every_shard(questions: DataFrame, shards: int = DEFAULT_SHARDS) -> DataFrame:
    """Every question once per shard. The shards are a short known list, so no join is needed."""
    return questions.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))


def shard_report(objects: DataFrame, batch: int = INSERT_BATCH) -> DataFrame:
    """Objects per shard, and how they fall into insert batches."""
    counted = objects.groupBy("shard").agg(F.count("*").alias("objects"))
    return counted.select(
        "shard",
        "objects",
        F.floor(F.col("objects") / batch).alias("full_batches"),
        (F.col("objects") % batch).alias("remainder"),
        F.ceil(F.col("objects") / batch).alias("batches"),
    )
