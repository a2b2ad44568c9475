"""k nearest vectors by cosine.

The items stay where they lie. Each task reads its items in Arrow batches, multiplies a batch with
the matrix of the questions and keeps k rows per question, so pairs exist only inside one batch's
product and a task hands on k rows per question, not pairs. Spark merges those by rank.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusloom.functions.vectors import certainty_of, distance_of
from corpusloom.operators.ranking import top_per_group

BROADCAST_BYTES = 64 << 20
CELL_BYTES = 128 << 20
# The grid sends an item to each of its columns and a question to each of its rows. There are so many of
# them at most, unless cells of CELL_BYTES or of CELL_PAIRS ask for more.
GRID_COPIES = 16
CELL_PAIRS = 4_000_000_000
# Rows that the tasks may hand on before the search is seeded with floors from a part of the items.
UNSEEDED_ROWS = 10_000_000
SEED_SHARE = 64
# Scores are compared at this many decimals, so that copies of a vector tie wherever they are
# scored; the lowest key wins a tie.
SCORE_DECIMALS = 12
PRODUCT_CELLS = 1_000_000  # a product that stays in the cache
STEP_ROWS = 2_048  # items that are held against the questions at once
EXACT_PAIRS, BYTE_PAIRS = 8_192, 512
TIES_PER_PLACE = 16
# Small whole numbers: sums of products up to 255 take a byte each, and a double holds six of them exactly.
LANES = 6
LANE_QUESTIONS = 512  # fewer are not worth the preparation
LANE_TILE = 256  # questions that are held against a step's items at once
LANE_GROUPS = 160  # elements that a vector is folded to; the square root is below both of the lengths below
ASKED_LENGTH, ITEM_LENGTH = 14.0, 18.0  # whose product is a byte
LANE_SLACK = 1e-3
CROWDED = 16  # a tile with more than one pair in so many left is searched in single precision
FIRST_ROWS = 256  # items of a task's first step, which gives the questions a floor
# A task hands on a row per question at least: from so many rows on there is one task per core.
ROWS_HANDED_ON = 10_000


@dataclass(frozen=True)
class Search:
    """What one task needs to know about the columns."""

    k: int
    asked_keys: tuple[str, ...]
    item_keys: tuple[str, ...]
    carry: tuple[str, ...]
    group: str | None
    per_group: bool
    overall: int | None = None  # of the groups' best, so many are wanted in the end


def _row_dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot product of each row of a with that of b, in double precision. Rows are summed one by one,
    so a pair's product does not depend on the rows around it. Sums of bytes are exact in single precision too."""
    small = a.dtype == b.dtype == np.uint8 and a.shape[1] * 255**2 < 2**24
    kind = np.float32 if small else np.float64
    return np.einsum("ij,ij->i", a.astype(kind), b.astype(kind)).astype(np.float64)


def _units(stored: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Vectors of length 1 in single precision."""
    unit = np.empty(stored.shape, dtype=np.float32)
    # By parts, as each part is in double precision for a moment.
    for at in range(0, len(stored), EXACT_PAIRS):
        part = slice(at, at + EXACT_PAIRS)
        unit[part] = stored[part] / np.sqrt(norms[part])[:, None]
    return unit


def _as_bytes(stored: np.ndarray) -> np.ndarray:
    """Whole numbers up to 255 as bytes, other values as they are."""
    if stored.dtype == np.uint8:
        return stored
    with np.errstate(invalid="ignore"):
        small = stored.astype(np.uint8)
        return small if (small == stored).all() else stored


PACKED = (np.uint8, np.float32, np.float64)  # what the values of a packed vector are, by its first byte


@F.arrow_udf(T.BinaryType())
def packed(vectors: pa.Array) -> pa.Array:
    """Vectors in as few bytes as hold their values, null for those that have no direction."""
    out: list[bytes | None] = [None] * len(vectors)
    sizes = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes[sizes > 0]):
        at = np.flatnonzero(sizes == size)
        usable = Vectors.of(vectors.take(pa.array(at)), at, int(size))
        for i, row in zip(usable.place.tolist(), usable.stored):
            row = _as_bytes(row)
            out[i] = bytes([PACKED.index(row.dtype.type)]) + row.tobytes()
    return pa.array(out, pa.binary())


def _unpacked(column: pa.Array, dim: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Values and row numbers of packed vectors of length ``dim``, or of the greatest length."""
    lengths = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    if len(column) and not column.null_count and (lengths == lengths[0]).all():
        start, end = (np.frombuffer(column.buffers()[1], np.int32)[column.offset + i] for i in (0, len(column)))
        table = np.frombuffer(column.buffers()[2], np.uint8)[start:end].reshape(len(column), -1)
        if (table[:, 0] == 0).all():
            right = dim in (None, table.shape[1] - 1)
            return (np.ascontiguousarray(table[:, 1:]), np.arange(len(column))) if right else (np.empty((0, dim), np.uint8), np.empty(0, np.int64))
    known = {i: np.frombuffer(row, PACKED[row[0]], offset=1) for i, row in enumerate(column.to_pylist()) if row}
    dim = max(map(len, known.values()), default=0) if dim is None else dim
    known = {i: row for i, row in known.items() if len(row) == dim}
    return np.stack([*known.values()]) if known else np.empty((0, dim), np.uint8), np.array([*known], dtype=np.int64)


@dataclass(frozen=True)
class Vectors:
    """Usable vectors of a column: values as stored, or as bytes where all of them are whole and small; squared
    norms, the row numbers they came from and the rows' places in key order."""

    stored: np.ndarray
    norms: np.ndarray
    rows: np.ndarray
    place: np.ndarray

    @staticmethod
    def of(column: pa.Array | pa.ChunkedArray, place: np.ndarray, dim: int | None = None) -> Vectors:
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        if pa.types.is_binary(column.type):
            stored, rows = _unpacked(column, dim)
        else:
            sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            if dim is None:
                dim = int(sizes.max(initial=0))
            rows = np.flatnonzero((sizes == dim) & (sizes > 0))
            flat = (column if len(rows) == len(column) else column.take(pa.array(rows))).flatten()
            stored = _as_bytes(flat.to_numpy(zero_copy_only=False).reshape(len(rows), dim))
        norms = np.concatenate([np.empty(0)] + [_row_dots(part, part) for part in np.split(stored, range(EXACT_PAIRS, len(stored), EXACT_PAIRS))])
        all_of = Vectors(stored, norms, rows, place[rows])
        good = np.isfinite(norms) & (norms > 0)
        return all_of if good.all() else all_of.take(np.flatnonzero(good))

    def take(self, at: np.ndarray) -> Vectors:
        return Vectors(self.stored[at], self.norms[at], self.rows[at], self.place[at])

    @cached_property
    def unit(self) -> np.ndarray:
        return _units(self.stored, self.norms)

    def units(self, at: np.ndarray) -> np.ndarray:
        """Unit vectors of some rows; those of bytes, of which there may be many, are not kept."""
        return _units(self.stored[at], self.norms[at]) if self.stored.dtype == np.uint8 else self.unit[at]


def _position_in_run(*columns: np.ndarray) -> np.ndarray:
    """Position of each row in its run of equal values."""
    at = np.arange(len(columns[0]))
    starts = np.zeros(len(at), dtype=bool)
    starts[:1] = True
    for column in columns:
        starts[1:] |= column[1:] != column[:-1]
    return at - np.maximum.accumulate(np.where(starts, at, 0))


def _without_spare_copies(items: Vectors, k: int) -> Vectors:
    """Items without copies of a vector beyond its k first in key order, which cannot win."""
    stored = np.ascontiguousarray(items.stored)
    _, kind = np.unique(stored.view(f"V{stored.shape[1] * stored.itemsize}").ravel(), return_inverse=True)
    order = np.lexsort((items.place, kind))
    return items.take(order[_position_in_run(kind[order]) < k])


def _scores(asked: Vectors, items: Vectors, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """Cosine of the given pairs in double precision, each computed alike wherever it occurs."""
    value = np.empty(len(row))
    step = EXACT_PAIRS if asked.stored.itemsize > 1 else BYTE_PAIRS
    for start in range(0, len(row), step):
        r, c = row[start : start + step], col[start : start + step]
        dots = _row_dots(asked.stored[r], items.stored[c])
        value[start : start + step] = dots / np.sqrt(asked.norms[r] * items.norms[c])
    return np.round(value, SCORE_DECIMALS)


def _best_of_tile(asked: Vectors, items: Vectors, part: np.ndarray, floor: np.ndarray, k: int):
    """Question, item row, and score of the k best items per question of ``part``, none below the
    question's floor; ties go to the first in key order. The product in single precision only
    rules out what is too far off by more than its rounding error; what is left is scored exactly."""
    slack = (asked.stored.shape[1] + 8) * 2.0**-23

    def candidates(items: Vectors, known: bool):
        near = asked.units(part) @ items.unit.T
        bar = (floor - slack).astype(np.float32)
        live = np.flatnonzero(near.max(axis=1) >= bar)
        if len(live) < len(near):
            # Most questions have a floor that nothing here reaches.
            near, bar = near[live], bar[live]
        if near.shape[1] > k and not (known and np.isfinite(bar).all()):
            kth = near.max(axis=1) if k == 1 else np.partition(near, near.shape[1] - k, axis=1)[:, -k]
            bar = np.maximum(bar, kth - np.float32(2 * slack))
        at = np.flatnonzero(near >= bar[:, None])
        return live[at // near.shape[1]], at % near.shape[1]

    row, col = candidates(items, True)
    if len(row) > TIES_PER_PLACE * k * len(part):
        row, col = candidates(items, False)
    if len(row) > TIES_PER_PLACE * k * len(part):
        items = _without_spare_copies(items, k)
        row, col = candidates(items, False)
    row = part[row]
    value = _scores(asked, items, row, col)
    order = np.lexsort((items.place[col], -value, row))
    order = order[_position_in_run(row[order]) < k]
    return row[order], items.rows[col[order]], value[order]


def _groups(stored: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The vectors' elements in ``LANE_GROUPS`` groups at most, as their order and the groups' starts. Elements that
    are seldom above 0 together share a group; any grouping gives right results."""
    used = (stored[:: -(-len(stored) // EXACT_PAIRS)] > 0).astype(np.float32)
    together = used.T @ used
    order = np.argsort(-together.diagonal(), kind="stable")
    members = [[e] for e in order[:LANE_GROUPS]]
    shared = together[:, order[:LANE_GROUPS]]
    for element in order[LANE_GROUPS:]:
        # A group that is as little shared, but smaller, is better.
        group = int(np.lexsort(([len(m) for m in members], shared[element]))[0])
        members[group].append(element)
        shared[:, group] += together[:, element]
    return np.concatenate(members), np.cumsum([0] + [len(m) for m in members[:-1]])


def _shortened(values: np.ndarray, length: float) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers, not below the values times the factor that is given with them, of no more than ``length``."""
    values = values.astype(np.float32)
    norms = np.sqrt(np.einsum("ij,ij->i", values, values))
    factor = np.where(norms > length, length / np.maximum(norms, 1), 1.0)
    whole = np.ceil(values * factor[:, None].astype(np.float32))
    while len(long := np.flatnonzero(np.einsum("ij,ij->i", whole, whole) > length * length)):
        factor[long] *= 0.9
        whole[long] = np.ceil(values[long] * factor[long, None])
    return whole.astype(np.uint8), factor


class Lanes:
    """Pairs of byte vectors whose cosine may reach the question's floor.

    Vectors are folded by groups of elements, the question's to sums and the item's to maxima, so the product of the
    folded ones is not below that of the vectors. What is too long is scaled down and rounded up. Each product is then
    a whole number up to 255, and one multiplication of doubles makes six of them side by side: an element holds
    those of six items, a byte each, and with 2 ** 52 added the bytes of the sum are the products. Comparing bytes with
    what the floor asks for leaves few pairs, which are scored exactly.
    """

    def __init__(self, asked: Vectors):
        self.asked = asked
        self.order, self.starts = _groups(asked.stored)
        parts = [_shortened(np.add.reduceat(asked.stored[at : at + EXACT_PAIRS, self.order], self.starts, axis=1, dtype=np.int32), ASKED_LENGTH) for at in range(0, len(asked.rows), EXACT_PAIRS)]
        self.folded, factor = (np.concatenate(part) for part in zip(*parts))
        self.reach = factor * np.sqrt(asked.norms)
        self.left = np.ones((LANE_TILE, len(self.starts) + 1))

    def pairs(self, items: Vectors, whose: np.ndarray, floor: np.ndarray):
        """Tiles of ``whose`` with the rows in it, items and scores of pairs that reach the floor, which must be
        above 0; None for them where too many may."""
        folded, factor = _shortened(np.maximum.reduceat(items.stored[:, self.order], self.starts, axis=1), ITEM_LENGTH)
        count, width = folded.shape
        columns = -(-count // LANES)
        padded = np.zeros((columns * LANES, width), dtype=np.uint8)
        padded[:count] = folded
        lanes = np.zeros((columns, width, 8), dtype=np.uint8)
        lanes[:, :, :LANES] = padded.reshape(columns, LANES, width).transpose(0, 2, 1)
        right = np.full((columns, width + 1), 2.0**52)
        right[:, :width] = lanes.view("<u8")[:, :, 0]
        reach = np.full(columns * LANES, np.inf)
        reach[:count] = factor * np.sqrt(items.norms)
        reach = reach.reshape(columns, LANES)
        wanted = np.zeros(len(floor))
        wanted[whose] = self.reach[whose] * floor[whose]
        # Questions that ask for about as much share a tile.
        whose = whose[np.argsort(wanted[whose], kind="stable")]
        products, enough = np.empty((LANE_TILE, columns)), np.empty((LANE_TILE, 8 * columns), dtype=bool)
        for start in range(0, len(whose), LANE_TILE):
            part = whose[start : start + LANE_TILE]
            bar = np.full((columns, 8), 255, dtype=np.uint8)
            bar[:, :LANES] = np.clip(np.ceil(wanted[part[0]] * reach - LANE_SLACK), 0, 255)
            self.left[: len(part), :width] = self.folded[part]
            np.matmul(self.left[: len(part)], right.T, out=products[: len(part)])
            found = products[: len(part)].view(np.uint8)
            # Few elements have a byte that is enough; these are looked at byte by byte.
            np.greater_equal(found, bar.ravel(), out=enough[: len(part)])
            at = np.flatnonzero(enough[: len(part)].view(np.uint64) != 0)
            if len(at) * CROWDED > len(part) * columns * LANES:
                yield part, None
                continue
            row, column = np.divmod(at, columns)
            row = part[row]
            hit, lane = np.nonzero(found.reshape(-1, 8)[at, :LANES] >= wanted[row, None] * reach[column] - LANE_SLACK)
            row, col = row[hit], column[hit] * LANES + lane
            value = _scores(self.asked, items, row, col)
            reached = value >= floor[row]
            yield part, (row[reached], col[reached], value[reached])


def _lists(column: pa.ChunkedArray, rows: np.ndarray):
    """Elements of a list column's given rows, with the position of the row each belongs to."""
    lists = column.combine_chunks().take(pa.array(rows))
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return lists.flatten(), np.repeat(np.arange(len(rows)), sizes)


def _search(batches: Iterable[pa.RecordBatch], questions: pa.Table, spec: Search) -> pa.Table | None:
    """k best items per question (and group, when kept per group) over a stream of batches.

    The questions come with their vector and, where these apply, the groups they look in and
    floors, scores that their k-th best of a group is known to reach."""
    asked = Vectors.of(questions["_vector"], np.arange(questions.num_rows))
    if not len(asked.rows):
        return None  # no question has a usable vector
    everyone = np.arange(len(asked.rows))
    probes = None
    if "_probes" in questions.column_names:
        cell, owner = _lists(questions["_probes"], asked.rows)
        cell = cell.to_numpy(zero_copy_only=False)
        order = np.argsort(cell, kind="stable")
        cells, starts = np.unique(cell[order], return_index=True)
        probes = dict(zip(cells.tolist(), np.split(owner[order], starts[1:])))
    floors: dict[int, np.ndarray] = {}
    if "_floors" in questions.column_names:
        known, owner = _lists(questions["_floors"], asked.rows)
        group, score = (known.field(name).to_numpy(zero_copy_only=False) for name in ("group", "score"))
        for g in np.unique(group):
            floors[int(g)] = np.full(len(everyone), -np.inf)
            floors[int(g)][owner[group == g]] = score[group == g]

    # Floors over all groups, where no more than the best of these are wanted in the end.
    top = spec.overall if spec.per_group else spec.k
    overall = np.full(len(everyone), -np.inf)
    if floors and (not spec.per_group or top is not None and top <= spec.k):
        overall = np.max([*floors.values()], axis=0)
    lanes = None
    if asked.stored.dtype == np.uint8 and len(everyone) >= LANE_QUESTIONS and probes is None and top is not None:
        lanes = Lanes(asked)

    by_key = [(key, "ascending") for key in spec.item_keys]
    # The best pairs so far as question, row of ``held``, score and group; ``held`` has the keys and carried
    # columns of each item once, however many questions it is among the best of.
    best = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64))
    held: pa.Table | None = None
    pending: list[tuple] = []

    def cut():
        """The best of what was found before and since, and the floors that follow from it."""
        nonlocal best, held, overall
        pairs, tables, rows = [best], [] if held is None else [held], 0 if held is None else held.num_rows
        for found, table in pending:
            pairs.append((found[0], found[1] + rows, *found[2:]))
            tables.append(table)
            rows += table.num_rows
        pending.clear()
        who, item, value, state = (np.concatenate(part) for part in zip(*pairs))
        used, item = np.unique(item, return_inverse=True)
        held = pa.concat_tables(tables).take(pa.array(used)).combine_chunks()
        place = np.empty(len(used), dtype=np.int64)
        place[pc.sort_indices(held, sort_keys=by_key).to_numpy()] = np.arange(len(used))
        order = np.lexsort((place[item], -value, who, state))
        position = _position_in_run(state[order], who[order])
        kept = order[position < spec.k]
        best = (who[kept], item[kept], value[kept], state[kept])
        last = order[position == spec.k - 1]
        for group in np.unique(state[last]):
            mine = last[state[last] == group]
            floors[int(group)][who[mine]] = np.maximum(floors[int(group)][who[mine]], value[mine])
        if top is not None:
            who, item, value, state = best
            order = np.lexsort((-value, who))
            last = order[_position_in_run(who[order]) == top - 1]
            overall[who[last]] = np.maximum(overall[who[last]], value[last])
            best = tuple(part[value >= overall[who]] for part in best)

    def steps():
        size = STEP_ROWS if lanes is None else min(FIRST_ROWS, STEP_ROWS)
        for batch in batches:
            start = 0
            while start < len(batch):
                yield batch.slice(start, size)
                start, size = start + size, STEP_ROWS

    for batch in steps():
        columns = pa.Table.from_batches([batch]).select([*spec.item_keys, *spec.carry])
        place = np.empty(len(batch), dtype=np.int64)
        place[pc.sort_indices(columns, sort_keys=by_key).to_numpy()] = np.arange(len(batch))
        items = Vectors.of(batch.column("_vector"), place, asked.stored.shape[1])
        groups = batch.column(spec.group).to_numpy()[items.rows] if spec.group else np.zeros(len(items.rows), dtype=np.int64)
        found = []
        for group in np.unique(groups) if spec.per_group else [0]:
            floors.setdefault(int(group), np.full(len(everyone), -np.inf))
        rest = everyone
        if lanes is not None and items.stored.dtype == np.uint8 and len(items.rows):
            # Copies beyond the k first cannot win; those of other groups are of other lists.
            parted = [items.take(np.flatnonzero(groups == g)) for g in np.unique(groups)] if spec.per_group else [items]
            some = Vectors(*(np.concatenate([getattr(_without_spare_copies(part, spec.k), name) for part in parted]) for name in ("stored", "norms", "rows", "place")))
            kinds = batch.column(spec.group).to_numpy()[some.rows] if spec.per_group else np.zeros(len(some.rows), dtype=np.int64)
            left = [np.flatnonzero(~(overall > 0))]
            for part, pairs in lanes.pairs(some, np.flatnonzero(overall > 0), overall):
                if pairs is None:
                    left.append(part)
                    continue
                who, col, value = pairs
                order = np.lexsort((some.place[col], -value, who, kinds[col]))
                order = order[_position_in_run(kinds[col[order]], who[order]) < spec.k]
                found.append((who[order], some.rows[col[order]], value[order], kinds[col[order]].astype(np.int64)))
            rest = np.concatenate(left)
        for group in np.unique(groups):
            whose = rest if probes is None else probes.get(int(group), everyone[:0])
            if not len(whose):
                continue
            mine = items.take(np.flatnonzero(groups == group)) if spec.group else items
            state = int(group) if spec.per_group else 0
            floor = floors[state] if top is None else np.maximum(floors[state], overall)
            tile = max(1, PRODUCT_CELLS // len(mine.rows))
            for start in range(0, len(whose), tile):
                part = whose[start : start + tile]
                who, which, value = _best_of_tile(asked, mine, part, floor[part], spec.k)
                found.append((who, which, value, np.full(len(who), state, dtype=np.int64)))
        if not found:
            continue
        who, which, value, state = (np.concatenate(part) for part in zip(*found))
        if top == 1:
            # What is found is a floor at once.
            np.maximum.at(overall, who, value)
            reached = value >= overall[who]
            who, which, value, state = who[reached], which[reached], value[reached], state[reached]
        if not len(who):
            continue
        used, which = np.unique(which, return_inverse=True)
        pending.append(((who, which, value, state), columns.take(pa.array(used))))
        # Sorting costs as much as there is, so it waits until there is half as much again.
        if 2 * sum(len(pairs[0]) for pairs, _ in pending) >= len(best[0]):
            cut()

    if pending:
        cut()
    if held is None:
        return None
    who, item, value, state = best
    owners = questions.select(list(spec.asked_keys)).take(pa.array(asked.rows)).take(pa.array(who))
    columns = {key: owners[key] for key in spec.asked_keys}
    if spec.per_group:
        columns[spec.group] = pa.array(state)
    winners = held.take(pa.array(item))
    columns |= {name: winners[name] for name in (*spec.item_keys, *spec.carry)}
    return pa.table(columns | {"score": pa.array(value)})


def _output_schema(asked: DataFrame, items: DataFrame, spec: Search) -> T.StructType:
    fields = [T.StructField(c, asked.schema[c].dataType) for c in spec.asked_keys]
    if spec.per_group:
        fields.append(T.StructField(spec.group, T.LongType()))
    fields += [T.StructField(c, items.schema[c].dataType) for c in (*spec.item_keys, *spec.carry)]
    return T.StructType([*fields, T.StructField("score", T.DoubleType())])


def _vector_bytes(asked: DataFrame, dim: int | None, vector: str) -> int:
    """Bytes of one vector as doubles, with an allowance for its key."""
    if dim is None:
        dim = asked.agg(F.max(F.size(vector))).first()[0]
    return 8 * max(dim or 1, 1) + 64


def _scan(asked: DataFrame, items: DataFrame, spec: Search, schema: T.StructType, deal: bool = False) -> DataFrame:
    """The items searched in place, with all questions sent to every task."""
    table = asked.toArrow()
    if table.num_rows * spec.k > ROWS_HANDED_ON and not deal:
        # The fewer tasks, the fewer rows are handed on, and the sooner most have a high floor.
        items = items.coalesce(asked.sparkSession.sparkContext.defaultParallelism)
    if "_probes" in table.column_names:
        # Items stored by cell are then read only where some question looks.
        cells = {cell for probed in table["_probes"].to_pylist() for cell in probed or ()}
        items = items.where(F.col(spec.group).isin(sorted(cells)))
    context = asked.sparkSession.sparkContext
    shared = context.broadcast(table)
    if deal:
        items = items.repartition(context.defaultParallelism, *spec.item_keys)
        if "_probes" in table.column_names:
            items = items.sortWithinPartitions(spec.group)  # a step then meets the questions of few cells

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _search(batches, shared.value, spec)
        pa.default_memory_pool().release_unused()  # the worker stays
        if best is not None:
            yield from best.to_batches(max_chunksize=10_000)

    return items.mapInArrow(scan, schema)


def _grid_shape(item_bytes: int, asked_bytes: int, pairs: int, cell_bytes: int) -> tuple[int, int]:
    """Rows and columns of the grid. Cells hold ``cell_bytes`` of each side as long as no more than
    ``GRID_COPIES`` of anything are sent for it, and ``CELL_BYTES`` beyond; so what is sent grows with the
    input until cells of that size or of ``CELL_PAIRS`` need more."""
    parts = lambda size, most: max(1, -(-size // most))
    side = lambda size: max(parts(size, max(cell_bytes, CELL_BYTES)), min(parts(size, cell_bytes), GRID_COPIES))
    rows, columns = side(item_bytes), side(asked_bytes)
    wanted = parts(pairs, CELL_PAIRS)
    if rows * columns < wanted:
        # Of all grids with that many cells, the one that sends the fewest bytes.
        rows = max(rows, round((wanted * item_bytes / asked_bytes) ** 0.5))
        columns = max(columns, parts(wanted, rows))
        rows = max(rows, parts(wanted, columns))
    return rows, columns


def _grid(asked: DataFrame, items: DataFrame, spec: Search, schema: T.StructType, rows: int, columns: int) -> DataFrame:
    """Every item in one row of a grid, every question in one column, both spread by their keys."""
    item_side = items.withColumn("_row", F.pmod(F.xxhash64(*spec.item_keys), F.lit(rows))).withColumn(
        "_column", F.explode(F.expr(f"sequence(0L, {columns - 1}L)"))
    )
    asked_side = asked.withColumn("_column", F.pmod(F.xxhash64(*spec.asked_keys), F.lit(columns))).withColumn(
        "_row", F.explode(F.expr(f"sequence(0L, {rows - 1}L)"))
    )
    nothing = to_arrow_schema(schema).empty_table()

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        best = _search(left.to_batches(max_chunksize=10_000), right, spec)
        return nothing if best is None else best

    return item_side.groupBy("_row", "_column").cogroup(asked_side.groupBy("_row", "_column")).applyInArrow(cell, schema)


def _with_floors(asked: DataFrame, candidates: DataFrame, spec: Search) -> DataFrame:
    """The questions with the k-th best score (per group) among ``candidates``, as far as there are k."""
    by = [*spec.asked_keys, *([spec.group] if spec.per_group else [])]
    order = [F.desc("score"), *[F.asc(c) for c in spec.item_keys]]
    ranked = candidates.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    group = F.col(spec.group) if spec.per_group else F.lit(0).cast("long")
    # One entry per group, of which there are few.
    floors = ranked.where(F.col("_rank") == spec.k).groupBy(*spec.asked_keys)
    floors = floors.agg(F.collect_list(F.struct(group.alias("group"), "score")).alias("_floors"))
    return asked.join(floors, list(spec.asked_keys), "left")


def nearest_candidates(
    asked: DataFrame,
    items: DataFrame,
    k: int,
    *,
    asked_keys: list[str],
    item_keys: list[str],
    asked_vector: str = "vector",
    item_vector: str = "vector",
    group: str | None = None,
    per_group: bool = False,
    probes: str | None = None,
    carry: list[str] = (),
    dim: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    cell_bytes: int = CELL_BYTES,
    unseeded_rows: int = UNSEEDED_ROWS,
    deal: bool = False,
    overall: int | None = None,
) -> DataFrame:
    """A superset of the k best items per question, exact once ranked: k rows per question and task.

    ``group`` names an integer column of the items. With ``per_group`` the k best are kept per
    group, as for shards. With ``probes``, an array column of the questions, a question meets only
    the groups it lists, as for cells of an approximate index. ``carry`` names item columns to hand
    on with the winners. ``dim`` is the vectors' length, asked of the questions where not given. ``overall``
    says how many of the groups' best are wanted in the end, so that none are handed on that so many of other groups
    beat.

    The questions are counted first, without those that nothing can match, and their vectors are packed: small whole
    numbers take a byte each. Up to ``broadcast_bytes`` they travel to the items, which are
    scanned in place without a shuffle. Beyond it the two sides are laid out as a grid: every item
    goes to one row of the grid, every question to one column, and each grid cell is one task of
    bounded size on both sides. ``deal`` spreads items that lie in a few files evenly over the cores
    before a scan; a grid spreads them anyhow.

    Many questions times many tasks are many rows to hand on. Past ``unseeded_rows`` a part of the
    items, told by a hash of their keys, is searched first. The k-th best score found there is one
    that the question's final k-th best reaches, so every task can leave out what lies below it.
    """
    spec = Search(k, tuple(asked_keys), tuple(item_keys), tuple(carry), group, per_group, overall)
    given = asked
    asked = asked.select(*asked_keys, packed(F.col(asked_vector)).alias("_vector"), *([F.col(probes).alias("_probes")] if probes else []))
    asked = asked.where("_vector is not null")
    items = items.select(*item_keys, *carry, F.col(item_vector).alias("_vector"), *([group] if group else []))
    schema = _output_schema(asked, items, spec)
    questions, size = asked.agg(F.count("*"), F.sum(F.octet_length("_vector") + 64)).first()
    if not questions:
        return asked.sparkSession.createDataFrame([], schema)  # nothing has a direction to search in

    if size <= broadcast_bytes:
        tasks = asked.sparkSession.sparkContext.defaultParallelism
        search = partial(_scan, spec=spec, schema=schema, deal=deal)
    else:
        n_items, row_bytes = max(1, items.count()), _vector_bytes(given, dim, asked_vector)
        tasks, columns = _grid_shape(n_items * row_bytes, questions * row_bytes, n_items * questions, cell_bytes)
        search = partial(_grid, spec=spec, schema=schema, rows=tasks, columns=columns)
    if questions * k * tasks > unseeded_rows:
        part = items.where(F.pmod(F.xxhash64(*item_keys), F.lit(SEED_SHARE)) == 0)
        asked = _with_floors(asked, search(asked, part), spec)
    return search(asked, items)


def rank_matches(candidates: DataFrame, k: int, by: list[str], item_keys: list[str]) -> DataFrame:
    """The k best per ``by`` with ``match_rank``, ``distance`` and ``certainty``; ties by item key.

    The candidates of one question, which come from every task, are cut in parts before they meet.
    """
    order = [F.desc("score"), *[F.asc(c) for c in item_keys]]
    ranked = top_per_group(candidates, by, order, k, rank="match_rank")
    return ranked.withColumn("distance", distance_of(F.col("score"))).withColumn("certainty", certainty_of(F.col("distance")))


def nearest(asked: DataFrame, items: DataFrame, k: int, *, asked_keys: list[str], item_keys: list[str], **options) -> DataFrame:
    """The k nearest items of every question."""
    candidates = nearest_candidates(asked, items, k, asked_keys=asked_keys, item_keys=item_keys, **options)
    return rank_matches(candidates, k, asked_keys, item_keys)


def nearest_by_shard(
    asked: DataFrame,
    items: DataFrame,
    shard_k: int,
    k: int,
    *,
    asked_keys: list[str],
    item_keys: list[str],
    shard: str = "shard",
    **options,
) -> DataFrame:
    """The best ``shard_k`` of every shard, merged to the best ``k`` overall."""
    candidates = nearest_candidates(
        asked, items, shard_k, asked_keys=asked_keys, item_keys=item_keys, group=shard, per_group=True, overall=k, **options
    )
    per_shard = rank_matches(candidates, shard_k, [*asked_keys, shard], item_keys)
    return rank_matches(per_shard.drop("match_rank", "distance", "certainty"), k, asked_keys, item_keys)


def order_by_certainty(matches: DataFrame, *ties: str) -> DataFrame:
    """Matches from the most certain down."""
    return matches.orderBy(F.desc("certainty"), *[F.asc(c) for c in ties])
