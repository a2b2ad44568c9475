"""Approximate search over product-quantised codes, with an exact re-rank of a short list.

A vector is cut into parts, and each part is replaced by the number of the nearest codeword of that
part. The inner product of a question with a coded vector is then a sum of table entries, one per
part, so a search reads the codes, a byte per part, and the vectors of its short list only.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusloom.functions.vectors import cosine, is_usable
from corpusloom.operators.nearest import BROADCAST_BYTES, CELL_BYTES, SCORE_DECIMALS, rank_matches
from corpusloom.operators.ranking import top_per_group

MOST_CODEWORDS = 256  # a code is one byte
SAMPLE_PER_CODEWORD = 64
APPROXIMATE_DECIMALS = 9
PRODUCT_CELLS = 1_000_000  # a product that stays in the cache
STEP_ROWS = 2_048  # codes that are held against the questions at once


@dataclass(frozen=True)
class Quantiser:
    """Cell centres (cells x dimension, unit length) and codewords (parts x codewords x width)."""

    centres: np.ndarray
    codewords: np.ndarray

    @property
    def dim(self) -> int:
        return self.centres.shape[1]

    def cells(self, unit: np.ndarray) -> np.ndarray:
        return np.argmax(unit @ self.centres.T, axis=1)

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """Number of the nearest codeword for every part; of equally near ones the first."""
        parts, _, width = self.codewords.shape
        pieces = unit.reshape(len(unit), parts, width)
        found = [((pieces[:, p, None] - self.codewords[p][None]) ** 2).sum(axis=2).argmin(axis=1) for p in range(parts)]
        return np.stack(found, axis=1).astype(np.uint8) if parts else np.zeros((len(unit), 0), np.uint8)

    def tables(self, unit: np.ndarray) -> np.ndarray:
        """Inner products of each question's parts with all codewords: parts x questions x codewords."""
        parts, _, width = self.codewords.shape
        pieces = unit.reshape(len(unit), parts, width)
        return np.stack([pieces[:, p] @ self.codewords[p].T for p in range(parts)])


def _units(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of a list column in double precision, and the rows they are in."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(sizes == dim)
    flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), dim)
    norms = np.einsum("ij,ij->i", flat, flat)
    good = np.isfinite(norms) & (norms > 0)
    return flat[good] / np.sqrt(norms[good])[:, None], rows[good]


def mean_centres(items: DataFrame, label: str, vector: str = "vector") -> np.ndarray:
    """The mean direction of each label's vectors, in order of label; labels are few."""
    rows = items.where(is_usable(F.col(vector))).select(F.col(label).alias("label"), F.posexplode(_unit(vector)).alias("at", "x"))
    means = rows.groupBy("label", "at").agg(F.avg("x").alias("x")).groupBy("label").agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("xs"))
    centres = np.array([[p.x for p in r.xs] for r in means.orderBy("label").collect()])
    return centres / np.linalg.norm(centres, axis=1, keepdims=True)


def _unit(vector: str):
    norm = F.aggregate(F.col(vector), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return F.transform(F.col(vector), lambda x: x.cast("double") / F.sqrt(norm))


def fit_codewords(items: DataFrame, key: str, parts: int, codewords: int, vector: str = "vector", rounds: int = 8) -> np.ndarray:
    """Codewords from a bounded sample: the vectors of lowest md5 of their key, ``SAMPLE_PER_CODEWORD``
    per codeword, and ``rounds`` of k-means on each part of them. With no round the codewords are the
    first vectors of the sample themselves."""
    if not 0 < codewords <= MOST_CODEWORDS:
        raise ValueError(f"between 1 and {MOST_CODEWORDS} codewords")
    usable = items.where(is_usable(F.col(vector))).select(F.col(vector).alias("v"), F.col(key).alias("k"))
    rows = usable.orderBy(F.md5(F.col("k").cast("string")), "k").limit(codewords * (SAMPLE_PER_CODEWORD if rounds else 1)).toArrow()
    lists = rows["v"].combine_chunks()
    dim = len(lists[0]) if len(lists) else parts
    if dim % parts:
        raise ValueError(f"{dim} dimensions are not {parts} equal parts")
    unit, _ = _units(lists, dim)
    pieces = unit.reshape(len(unit), parts, dim // parts)
    chosen = np.ascontiguousarray(pieces[:codewords].transpose(1, 0, 2))
    for _ in range(rounds):
        for p in range(parts):
            nearest = ((pieces[:, p, None] - chosen[p][None]) ** 2).sum(axis=2).argmin(axis=1)
            size = np.bincount(nearest, minlength=chosen.shape[1])
            sums = np.zeros_like(chosen[p])
            np.add.at(sums, nearest, pieces[:, p])
            chosen[p][size > 0] = sums[size > 0] / size[size > 0, None]
    return chosen


def encode(items: DataFrame, quantiser: Quantiser, vector: str = "vector") -> DataFrame:
    """Items with their ``cell`` and ``codes``; both null where the vector cannot be used."""

    def code(vectors: pa.Array) -> pa.Array:
        unit, rows = _units(vectors, quantiser.dim)
        cells, codes = np.full(len(vectors), -1), [None] * len(vectors)
        cells[rows] = quantiser.cells(unit)
        for row, coded in zip(rows, quantiser.codes(unit)):
            codes[row] = coded.tobytes()
        return pa.StructArray.from_arrays([pa.array(cells, pa.int32(), mask=cells < 0), pa.array(codes, pa.binary())], names=["cell", "codes"])

    coded = F.arrow_udf(code, "cell int, codes binary")(F.col(vector))
    return items.withColumn("_coded", coded).select(*items.columns, "_coded.cell", "_coded.codes")


def _short_list(batches: Iterable[pa.RecordBatch], asked: pa.Table, quantiser: Quantiser, keys: tuple[list, list], probes: int, size: int):
    """The ``size`` items of highest approximate product per question over a stream of batches."""
    asked_keys, item_keys = keys
    unit, rows = _units(asked["_vector"].combine_chunks(), quantiser.dim)
    tables = quantiser.tables(unit)
    near = np.argsort(-(unit @ quantiser.centres.T), axis=1, kind="stable")[:, :probes]
    probed = np.zeros((len(unit), len(quantiser.centres)), bool)
    np.put_along_axis(probed, near, True, axis=1)
    by_key = [(k, "ascending") for k in item_keys]
    words = quantiser.codewords.astype(np.float32)
    parts, dim = np.arange(len(words)), quantiser.dim
    single, floor = unit.astype(np.float32), np.full(len(unit), -np.inf)
    # The best pairs so far as question, row of ``held`` and product; ``held`` has each of their items once.
    best = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
    held: pa.Table | None = None
    pending: list[tuple] = []

    def cut():
        """The best of what was found before and since, and the floors that follow from it."""
        nonlocal best, held
        pairs, tables_, rows_ = [best], [] if held is None else [held], 0 if held is None else held.num_rows
        for found, table in pending:
            pairs.append((found[0], found[1] + rows_, found[2]))
            tables_.append(table)
            rows_ += table.num_rows
        pending.clear()
        who, item, value = (np.concatenate(x) for x in zip(*pairs))
        used, item = np.unique(item, return_inverse=True)
        held = pa.concat_tables(tables_).take(pa.array(used)).combine_chunks()
        place = np.empty(len(used), np.int64)
        place[pc.sort_indices(held, sort_keys=by_key).to_numpy()] = np.arange(len(used))
        order = np.lexsort((place[item], -value, who))
        owner = who[order]
        position = np.arange(len(owner)) - np.searchsorted(owner, owner, "left")
        kept, last = order[position < size], order[position == size - 1]
        best = (who[kept], item[kept], value[kept])
        floor[who[last]] = value[last]

    for batch in (b.slice(start, STEP_ROWS) for b in batches for start in range(0, len(b), STEP_ROWS)):
        batch = pa.Table.from_batches([batch])
        batch = batch.filter(batch["codes"].is_valid()).sort_by(by_key)
        if not batch.num_rows or not len(unit):
            continue
        codes = np.frombuffer(b"".join(batch["codes"].to_pylist()), np.uint8).reshape(batch.num_rows, -1)
        cells = batch["cell"].to_numpy()
        # The sum of table entries is the product with the codewords in a row. In single precision it rules
        # out what is too far off by more than its rounding error; the tables give what is left.
        coded = words[parts, codes].reshape(len(codes), dim)
        slack = (dim + 8) * 2.0**-23 * max(1.0, float(np.sqrt((coded**2).sum(axis=1).max()))) + 10.0**-APPROXIMATE_DECIMALS
        found = []
        step = max(1, PRODUCT_CELLS // batch.num_rows)
        for a in range(0, len(unit), step):
            near = single[a : a + step] @ coded.T
            bar = (floor[a : a + step] - slack).astype(np.float32)
            live = np.flatnonzero(near.max(axis=1) >= bar)
            if len(live) < len(near):
                near, bar = near[live], bar[live]
            unknown = np.flatnonzero(~np.isfinite(bar))
            if len(unknown) and near.shape[1] > size:
                met = np.where(probed[a + live[unknown]][:, cells], near[unknown], np.float32(-np.inf))
                bar[unknown] = np.partition(met, met.shape[1] - size, axis=1)[:, -size] - np.float32(2 * slack)
            at = np.flatnonzero(near >= bar[:, None])
            who, which = a + live[at // near.shape[1]], at % near.shape[1]
            mine = probed[who, cells[which]]
            who, which = who[mine], which[mine]
            value = np.zeros(len(who))
            for p in parts:
                value += tables[p, who, codes[which, p]]
            found.append((who, which, np.round(value, APPROXIMATE_DECIMALS)))
        who, which, value = (np.concatenate(x) for x in zip(*found))
        used, which = np.unique(which, return_inverse=True)
        pending.append(((who, which, value), batch.select([*item_keys, "cell"]).take(pa.array(used))))
        # Sorting costs as much as there is, so it waits until there is half as much again.
        if 2 * sum(len(pairs[0]) for pairs, _ in pending) >= len(best[0]):
            cut()
    if pending:
        cut()
    if held is None:
        return None
    who, item, value = best
    owners = asked.select(asked_keys).take(pa.array(rows)).take(pa.array(who))
    winners = held.take(pa.array(item))
    return pa.table({**{k: owners[k] for k in asked_keys}, **{c: winners[c] for c in [*item_keys, "cell"]}, "approximate": pa.array(value)})


def nearest_coded(
    asked: DataFrame,
    index: DataFrame,
    quantiser: Quantiser,
    k: int,
    *,
    probes: int,
    short_list: int,
    asked_keys: list[str],
    item_keys: list[str],
    vector: str = "vector",
    broadcast_bytes: int = BROADCAST_BYTES,
    cell_bytes: int = CELL_BYTES,
) -> DataFrame:
    """The k best of a short list of items per question, by cosine: ``asked_keys, item_keys, score,
    match_rank, distance, certainty``.

    ``index`` is what ``encode`` returns, best stored by cell. Its codes are scanned in place, with the
    questions broadcast while they are under ``broadcast_bytes`` and laid out as a grid with the
    codes beyond. The ``short_list`` items of highest approximate product among a question's
    ``probes`` nearest cells are fetched by cell and key and scored exactly; ties go to the lower key.

    Defined results: questions and items without a usable vector are in no result; an item key must
    be unique.
    """
    asked = asked.select(*asked_keys, F.col(vector).alias("_vector"))
    coded = index.select(*item_keys, "cell", "codes")
    kind = T.StructType(
        [asked.schema[c] for c in asked_keys] + [index.schema[c] for c in [*item_keys, "cell"]] + [T.StructField("approximate", T.DoubleType())]
    )
    nothing = to_arrow_schema(kind).empty_table()
    names = (list(asked_keys), list(item_keys))
    search = lambda batches, table: _short_list(batches, table, quantiser, names, probes, short_list)
    questions = asked.count()
    question_bytes = 8 * (quantiser.dim + quantiser.codewords.shape[0] * quantiser.codewords.shape[1]) + 64
    if questions * question_bytes <= broadcast_bytes:
        shared = asked.sparkSession.sparkContext.broadcast(asked.toArrow())

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = search(batches, shared.value)
            if found is not None:
                yield from found.cast(nothing.schema).to_batches(max_chunksize=10_000)

        candidates = coded.mapInArrow(scan, kind)
    else:
        columns = -(-questions * question_bytes // cell_bytes)
        code_bytes = quantiser.codewords.shape[0] + 64
        rows = max(1, -(-index.count() * code_bytes // cell_bytes))
        deal = lambda df, keys, name, n: df.withColumn(name, F.pmod(F.xxhash64(*keys), F.lit(n)))
        every = lambda df, name, n: df.withColumn(name, F.explode(F.expr(f"sequence(0L, {n - 1}L)")))
        left = every(deal(coded, item_keys, "_row", rows), "_column", columns).groupBy("_row", "_column")
        right = every(deal(asked, asked_keys, "_column", columns), "_row", rows).groupBy("_row", "_column")

        def cell(items: pa.Table, table: pa.Table) -> pa.Table:
            found = search(items.to_batches(max_chunksize=10_000), table) if table.num_rows else None
            return nothing if found is None else found.cast(nothing.schema)

        candidates = left.cogroup(right).applyInArrow(cell, kind)
    order = [F.desc("approximate"), *[F.asc(c) for c in item_keys]]
    chosen = top_per_group(candidates, asked_keys, order, short_list)
    vectors = index.select(*item_keys, "cell", F.col(vector).alias("_item"))
    exact = chosen.join(vectors, [*item_keys, "cell"]).join(asked, asked_keys)
    scored = exact.select(*asked_keys, *item_keys, F.round(cosine(F.col("_vector"), F.col("_item")), SCORE_DECIMALS).alias("score"))
    return rank_matches(scored, k, asked_keys, item_keys)
