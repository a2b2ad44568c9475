"""Connected components of a link table, by union-find within tasks and contraction between them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.store import stored


def _union_find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one task as stars: every node with the lowest node it is joined to."""
    parent: dict = {}

    def root(x):
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    schema = None
    for batch in batches:
        schema = batch.schema
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    if schema is not None:
        nodes = [x for x in parent if root(x) != x]
        yield pa.record_batch([pa.array(nodes, schema[0].type), pa.array([root(x) for x in nodes], schema[1].type)], schema=schema)


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of the links ``a, b``; the component is its lowest node.

    Each round reduces the links of every task to stars by union-find, points each node at its
    lowest neighbour and replaces the nodes by what they point at. Nodes are digests, so the order
    is random to the graph and the rounds are few. Nothing is gathered anywhere: the rounds only
    ask whether links are left. A node in no link is in no row; links of a node with itself and
    repeated links change nothing.
    """
    left = links.select("a", "b").where("a <> b")
    kind = f"a {left.schema['a'].dataType.simpleString()}, b {left.schema['a'].dataType.simpleString()}"
    labels = None
    while True:
        left = stored(left.mapInArrow(_union_find, kind), "links")
        if left.isEmpty():
            break
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("b"))
        step = stored(lowest.select(F.col("a").alias("node"), F.least("a", "b").alias("up")), "parents")
        moved = left.join(step.select(F.col("node").alias("a"), F.col("up").alias("up_a")), "a")
        moved = moved.join(step.select(F.col("node").alias("b"), F.col("up").alias("up_b")), "b")
        left = moved.where("up_a <> up_b").select(F.least("up_a", "up_b").alias("a"), F.greatest("up_a", "up_b").alias("b")).distinct()
        if labels is None:
            labels = step.withColumnRenamed("up", "component")
        else:
            above = step.select(F.col("node").alias("component"), F.col("up"))
            labels = labels.join(above, "component", "left").select("node", F.coalesce("up", "component").alias("component"))
    if labels is None:
        spark = links.sparkSession
        node = links.schema["a"].dataType.simpleString()
        return spark.createDataFrame([], f"node {node}, component {node}")
    return stored(labels, "labels")
