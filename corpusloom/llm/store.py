"""Tables, and where intermediate results are kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import work_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again, so that what follows does not depend
    on any executor still being there."""
    spark, path = df.sparkSession, work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame, *names: str) -> DataFrame:
    """The rows as one column ``row`` beside the named ones, so that no column can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *names)


def same(a: Column, b: Column) -> Column:
    """Equality that also holds between nulls."""
    return a.eqNullSafe(b)


def literal_array(values: list[int], kind: str) -> Column:
    """A list of integers as one literal array, folded once while the query is planned."""
    return F.from_json(F.lit("[" + ",".join(map(str, values)) + "]"), f"array<{kind}>")
