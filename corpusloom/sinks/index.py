"""Writing the chunk index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

WRITERS_KEY = "spark.sql.maxConcurrentOutputFileWriters"
WRITERS = 16  # files that a task writes side by side, unless the session says how many


def write_index(objects: DataFrame, path: str, replace: bool = True, compact: bool = False, by: str = "shard") -> None:
    """Objects as parquet with one folder per shard, rejects in a folder of their own. An index for
    approximate search is stored ``by`` cell.

    ``replace=False`` leaves an existing index alone. Every task writes its rows of each shard
    straight away, which at scale gives files of a sensible size without a shuffle. For small
    inputs ``compact`` first gathers the shards' rows; AQE then sizes the files, and splits a
    shard that is too large for one.
    """
    rows = objects.hint("rebalance", by) if compact else objects
    conf = objects.sparkSession.conf
    before = conf.get(WRITERS_KEY, "0")
    if before == "0":
        conf.set(WRITERS_KEY, str(WRITERS))  # else a task sorts its rows by shard first
    try:
        rows.write.mode("overwrite" if replace else "ignore").partitionBy(by).parquet(path)
    finally:
        conf.set(WRITERS_KEY, before)


def replace_shards(objects: DataFrame, path: str) -> None:
    """Overwrite only the shards that ``objects`` holds."""
    writer = objects.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("shard").parquet(path)


def drop_shards(spark: SparkSession, path: str, shards: list[int]) -> None:
    """Remove the folders of shards that have no row left."""
    for shard in shards:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/shard={shard}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
