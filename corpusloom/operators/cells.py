"""Approximate search: items in k-means cells, questions against their nearest cells only."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.vectors import is_usable
from corpusloom.operators.nearest import nearest


def fit_cells(
    items: DataFrame, cells: int, vector: str = "vector", seed: int = 0, rounds: int = 10
) -> KMeansModel:
    """k-means centres by cosine. The centres, ``cells`` times the dimension, are all that is kept.

    Every round reads all items. Vectors without a direction (see ``is_usable``) do not count.
    """
    features = items.where(is_usable(F.col(vector))).select(array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    return KMeans(k=cells, seed=seed, maxIter=rounds, distanceMeasure="cosine").fit(features)


def assign_cells(items: DataFrame, model: KMeansModel, vector: str = "vector", cell: str = "cell") -> DataFrame:
    """Items with the cell they fall into."""
    features = items.withColumn("_features", array_to_vector(F.col(vector).cast("array<double>")))
    placed = model.copy({model.featuresCol: "_features", model.predictionCol: cell}).transform(features)
    return placed.drop("_features")


def cells_to_probe(model: KMeansModel, vector: Column, probes: int) -> Column:
    """The ``probes`` cells nearest to a vector, as an array."""
    centres = np.array(model.clusterCenters())
    centres = centres / np.linalg.norm(centres, axis=1, keepdims=True)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def choose(vectors: pa.Array) -> pa.Array:
        sizes = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(sizes == centres.shape[1])
        flat = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        scores = flat.astype(np.float64).reshape(len(rows), -1) @ centres.T
        chosen = np.argsort(-scores, axis=1, kind="stable")[:, :probes].astype(np.int32)
        lists = [None] * len(sizes)
        for row, cells in zip(rows, chosen):
            lists[row] = cells
        return pa.array(lists, pa.list_(pa.int32()))

    return choose(vector)


def nearest_in_cells(
    asked: DataFrame,
    items: DataFrame,
    model: KMeansModel,
    k: int,
    probes: int,
    *,
    asked_keys: list[str],
    item_keys: list[str],
    vector: str = "vector",
    cell: str = "cell",
    **options,
) -> DataFrame:
    """The k nearest items among the cells a question probes; exact when it probes all of them."""
    aimed = asked.withColumn("_cells", cells_to_probe(model, F.col(vector), probes))
    return nearest(
        aimed,
        items,
        k,
        asked_keys=asked_keys,
        item_keys=item_keys,
        asked_vector=vector,
        item_vector=vector,
        group=cell,
        probes="_cells",
        **options,
    )
