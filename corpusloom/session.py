"""Session set-up and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "corpusloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for.

    AQE sizes the shuffles and splits skewed join partitions at run time, so no partition count is
    fixed here; pass ``spark.sql.shuffle.partitions`` for small local runs.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Cut the rows of a group in the map tasks however many of them are asked for.
        .config("spark.sql.optimizer.windowGroupLimitThreshold", str(2**31 - 1))
        # A task writes a handful of shard folders side by side, without sorting its rows by shard.
        .config("spark.sql.maxConcurrentOutputFileWriters", "16")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table, under the cluster's shared checkpoint folder.

    Where ``spark.checkpoint.dir`` is unset a local master gets a temporary folder; a cluster is
    refused, because a machine-local folder would be lost with the machine.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
        root = _local_root()
    return f"{root.rstrip('/')}/corpusloom/{name}-{uuid.uuid4().hex}"


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="corpusloom-")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a scan by key when it has fewer splits than the cluster has cores.

    A table of many row groups is left alone, so at scale this adds no shuffle; it only keeps one
    small file from tying the CPU-heavy steps after it to one core. Meant for plain scans.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)
