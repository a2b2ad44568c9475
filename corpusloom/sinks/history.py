"""Writing chat history."""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import DataFrame, SparkSession

from corpusloom.operators.history import replay_buckets

HISTORY_COLUMNS = ("conv_id", "turn", "role", "text")
BUCKETS = 64


def append_history(turns: DataFrame, path: str) -> None:
    turns.select(*HISTORY_COLUMNS).write.mode("append").parquet(path)


def history_table(spark: SparkSession, path: str, buckets: int = BUCKETS) -> str:
    """The history under ``path`` as a table bucketed by conversation and sorted by turn within; its
    name in the session's catalog. The rows are all in the folder, so any session can open them;
    ``buckets`` must be the number they were written with."""
    name = f"history_{md5(path.encode()).hexdigest()}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (conv_id BIGINT, turn BIGINT, role STRING, text STRING) USING parquet "
        f"CLUSTERED BY (conv_id) SORTED BY (conv_id, turn) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    spark.catalog.refreshTable(name)
    return name


def append_bucketed(turns: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Append turns to a bucketed history. They are dealt the way the buckets are, so each append
    adds one file to a bucket at most."""
    spark = turns.sparkSession
    rows = turns.select(*[turns[c].cast("string" if c in ("role", "text") else "bigint").alias(c) for c in HISTORY_COLUMNS])
    rows.repartition(buckets, "conv_id").write.mode("append").insertInto(history_table(spark, path, buckets))


def compact_history(spark: SparkSession, path: str, target: str, buckets: int = BUCKETS) -> None:
    """Write a bucketed history anew under ``target``, one file per bucket, in order of conversation and
    turn. Its buckets are read as they lie, so no row is shuffled."""
    rows = replay_buckets(spark.table(history_table(spark, path, buckets))).where("place >= 1").drop("place")
    rows.write.mode("append").insertInto(history_table(spark, target, buckets))
