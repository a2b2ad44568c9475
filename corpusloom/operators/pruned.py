"""Exact search over items stored by cell, reading only cells that can hold a neighbour.

A cell is known by its centre and its radius, the largest angle between the centre and an item. By
the triangle inequality no item of a cell is nearer to a question than the angle to the centre less
the radius, so a cell for which even that is worse than k items already found is not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.vectors import is_usable
from corpusloom.operators.nearest import nearest

SLACK = 1e-9  # an angle's rounding error


def _unit_rows(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(sizes == dim)
    flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), dim)
    norms = np.linalg.norm(flat, axis=1)
    good = np.isfinite(norms) & (norms > 0)
    return flat[good] / norms[good][:, None], rows[good]


def place_in_cells(items: DataFrame, centres: np.ndarray, vector: str = "vector", cell: str = "cell") -> DataFrame:
    """Items with the cell of the centre nearest to them; vectors without a direction are in cell -1.
    ``centres`` are rows of unit length."""

    def place(vectors: pa.Array) -> pa.Array:
        unit, rows = _unit_rows(vectors, centres.shape[1])
        cells = np.full(len(vectors), -1, np.int32)
        cells[rows] = np.argmax(unit @ centres.T, axis=1)
        return pa.array(cells)

    return items.withColumn(cell, F.arrow_udf(place, "int")(F.col(vector)))


def cell_radii(placed: DataFrame, centres: np.ndarray, vector: str = "vector", cell: str = "cell") -> DataFrame:
    """``cell, items, radius``: the largest angle between a cell's centre and its items, in radians. One
    row per cell, to be stored beside the index."""

    def angle(vectors: pa.Array, cells: pa.Array) -> pa.Array:
        unit, rows = _unit_rows(vectors, centres.shape[1])
        angles = np.full(len(vectors), np.nan)
        own = centres[cells.to_numpy(zero_copy_only=False)[rows]]
        angles[rows] = np.arccos(np.clip(np.einsum("ij,ij->i", unit, own), -1, 1))
        return pa.array(angles, mask=np.isnan(angles))

    rows = placed.where((F.col(cell) >= 0) & is_usable(F.col(vector)))
    angles = rows.select(cell, F.arrow_udf(angle, "double")(F.col(vector), F.col(cell)).alias("angle"))
    return angles.groupBy(cell).agg(F.count("*").alias("items"), F.max("angle").alias("radius"))


def cells_within_reach(asked: DataFrame, centres: np.ndarray, radii: dict[int, float], vector: str = "vector", floor: str = "floor") -> DataFrame:
    """Questions with ``_cells``, those that may hold an item of a cosine of ``floor`` or more; all of the
    cells where the floor is null."""
    known = np.array(sorted(radii), np.int32)
    radius = np.array([radii[c] for c in known])

    def choose(vectors: pa.Array, floors: pa.Array) -> pa.Array:
        unit, rows = _unit_rows(vectors, centres.shape[1])
        least = floors.fill_null(-2.0).to_numpy(zero_copy_only=False)[rows]
        angles = np.arccos(np.clip(unit @ centres[known].T, -1, 1))
        best = np.cos(np.maximum(angles - radius[None, :] - SLACK, 0))
        lists = [None] * len(vectors)
        for row, wanted in zip(rows, best >= least[:, None] - SLACK):
            lists[row] = known[wanted]
        return pa.array(lists, pa.list_(pa.int32()))

    return asked.withColumn("_cells", F.arrow_udf(choose, "array<int>")(F.col(vector), F.col(floor)))


def nearest_pruned(
    asked: DataFrame,
    placed: DataFrame,
    centres: np.ndarray,
    radii: DataFrame,
    k: int,
    *,
    asked_keys: list[str],
    item_keys: list[str],
    vector: str = "vector",
    cell: str = "cell",
    **options,
) -> DataFrame:
    """The k nearest items of every question, as ``nearest`` finds them, of items stored by ``cell``.

    Each question is first held against the cell it would fall into itself. The cosine of the k-th
    item there is a floor, and only cells that may reach it are read for it; a question whose own
    cell has fewer than k items reads all of them. Cells that no question reaches are not scanned.
    ``radii``, a row per cell, is read by the driver.
    """
    radius = {r[cell]: r["radius"] for r in radii.collect()}
    common = dict(asked_keys=asked_keys, item_keys=item_keys, asked_vector=vector, item_vector=vector, group=cell, dim=centres.shape[1], **options)
    asked = asked.select(*asked_keys, vector)
    own = place_in_cells(asked, centres, vector, "_own").withColumn("_cells", F.when(F.col("_own") >= 0, F.array("_own")))
    first = nearest(own, placed, k, probes="_cells", **common)
    floors = first.where(F.col("match_rank") == k).select(*asked_keys, F.col("score").alias("floor"))
    reaching = cells_within_reach(asked.join(floors, asked_keys, "left"), centres, radius, vector)
    return nearest(reaching, placed, k, probes="_cells", **common)
