"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.store import stored
from corpusloom.llm.words import U, byte_classes, chunks, gram_hashes, powers, word_hashes

SHORTEST = 5  # words in the shortest tile, and in a seed
COVERAGE = 0.5
BLOCK_BYTES = 8 << 20
MATCHES = "array<struct<item_id:bigint,n_words:bigint,covered:bigint,n_tiles:bigint>>"
FIELDS = ("item_id", "n_words", "covered", "n_tiles")


@cache
def _classes():
    letter = lambda b: b >= 128 or chr(b).isalnum()
    return byte_classes(letter, lambda b: b + 32 if 65 <= b <= 90 else b)


def _windows(sums: np.ndarray, marked: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Karp-Rabin hashes of the windows of a length that hold no marked word, and their places."""
    starts = np.flatnonzero(marked[length:] == marked[:-length])
    _, down = powers(len(sums))
    return (sums[starts + length] - sums[starts]) * down[starts], starts


def tiles(item: np.ndarray, doc: np.ndarray, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two word sequences: ``(place in item, place in doc, length)``.

    The longest match of unmarked words is marked, again and again, until none of ``shortest``
    words is left; among equally long ones the first in the item, then the first in the document.
    The length of the longest match is found by bisection, as a match holds matches of any shorter
    length; each step compares the rolling hashes of all windows.
    """
    sequences, sums, taken = (item, doc), [], []
    for words in sequences:
        up, _ = powers(len(words) + 1)
        sums.append(np.concatenate([np.zeros(1, U), np.cumsum(words * up[: len(words)])]))
        taken.append(np.zeros(len(words), bool))
    out, limit = [], min(len(item), len(doc))

    def match(length: int) -> tuple[int, int] | None:
        marked = [np.concatenate([[0], np.cumsum(t)]) for t in taken]
        a, at_a = _windows(sums[0], marked[0], length)
        b, at_b = _windows(sums[1], marked[1], length)
        if not len(a) or not len(b):
            return None
        order = np.argsort(b, kind="stable")
        found = np.searchsorted(b[order], a)
        hit = np.flatnonzero(b[order[np.minimum(found, len(b) - 1)]] == a)
        for k in hit:
            i, j = int(at_a[k]), int(at_b[order[found[k]]])
            if (item[i : i + length] == doc[j : j + length]).all():
                return i, j
        return None

    while limit >= shortest:
        best, best_length, low, high = match(limit), limit, shortest, limit - 1
        while best is None or best_length < limit and low <= high:
            if low > high:
                return out
            middle = (low + high) // 2
            if (got := match(middle)) is not None:
                best, best_length, low = got, middle, middle + 1
            else:
                high = middle - 1
                if best is None and low > high:
                    return out
        i, j = best
        out.append((i, j, best_length))
        taken[0][i : i + best_length] = taken[1][j : j + best_length] = True
        limit = best_length
    return out


class _Block:
    """Word hashes of a bounded block of items, and the items of each seed."""

    def __init__(self, rows: list[tuple[int, str]], shortest: int):
        self.ids = [i for i, _ in rows]
        self.words, grams, owner = [], [], []
        for data, offsets, _ in chunks(pa.array([t for _, t in rows], pa.large_string())):
            words, first = word_hashes(data, offsets, _classes())
            for a, b in zip(first[:-1], first[1:]):
                g = np.unique(gram_hashes(words[a:b], shortest))
                owner.append(np.full(len(g), len(self.words)))
                self.words.append(words[a:b])
                grams.append(g)
        flat = np.concatenate(grams) if grams else np.zeros(0, U)
        owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.owner = owner[order]
        self.grams, self.first = np.unique(flat[order], return_index=True)
        self.first = np.append(self.first, len(flat))
        self.bits = np.zeros(1 << 22, bool)
        self.bits[self.grams & U((1 << 22) - 1)] = True

    def seeds(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the grams are seeds, and which seed each one is."""
        maybe = np.flatnonzero(self.bits[grams & U((1 << 22) - 1)])
        if not len(self.grams):
            return maybe[:0], maybe[:0]
        at = np.minimum(np.searchsorted(self.grams, grams[maybe]), len(self.grams) - 1)
        good = self.grams[at] == grams[maybe]
        return maybe[good], at[good]


def _match_chunk(block: _Block, data, offsets, shortest: int, coverage: float) -> list[list[tuple]]:
    out: list[list[tuple]] = [[] for _ in range(len(offsets) - 1)]
    words, first = word_hashes(data, offsets, _classes())
    text = np.repeat(np.arange(len(out)), np.diff(first))
    grams = gram_hashes(words, shortest)
    at, seed = block.seeds(grams)
    inside = text[at] == text[at + shortest - 1] if len(at) else np.zeros(0, bool)
    shared = np.unique(np.stack([text[at[inside]], seed[inside]], axis=1), axis=0) if inside.any() else np.zeros((0, 2), np.int64)
    counts = block.first[shared[:, 1] + 1] - block.first[shared[:, 1]]
    places = np.repeat(block.first[shared[:, 1]] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum()) if len(shared) else np.zeros(0, np.int64)
    pairs = np.stack([np.repeat(shared[:, 0], counts), block.owner[places]], axis=1)
    pairs, n_seeds = np.unique(pairs, axis=0, return_counts=True) if len(pairs) else (pairs, counts)
    for (d, k), n in zip(pairs, n_seeds):
        item, doc = block.words[k], words[first[d] : first[d + 1]]
        # A distinct seed stands for at most as many places in the item as it occurs there; with
        # no repeats, n seeds cover at most n * shortest words.
        repeated = len(item) - shortest + 1 > len(np.unique(gram_hashes(item, shortest)))
        if not repeated and n * shortest < coverage * len(item):
            continue
        marks = tiles(item, doc, shortest)
        covered = sum(length for _, _, length in marks)
        if covered >= coverage * len(item):
            out[d].append((block.ids[k], len(item), covered, len(marks)))
    return out


def matcher(block, shortest: int, coverage: float):
    """Column function over texts: the items of a broadcast block that a text covers."""
    kind = pa.list_(pa.struct([(f, pa.int64()) for f in FIELDS]))

    def find(texts: pa.Array) -> pa.Array:
        rows = []
        for data, offsets, _ in chunks(texts):
            rows += _match_chunk(block.value, data, offsets, shortest, coverage)
        return pa.array([[dict(zip(FIELDS, x)) for x in r] for r in rows], kind)

    return F.arrow_udf(find, MATCHES)


def blocks_of(items: DataFrame, shortest: int, block_bytes: int) -> Iterator:
    """The benchmark in blocks of bounded size, each broadcast in turn."""
    items = items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    n = -(-total // block_bytes)
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield items.sparkSession.sparkContext.broadcast(_Block([tuple(r) for r in part.collect()], shortest))


def benchmark_matches(
    docs: DataFrame, items: DataFrame, shortest: int = SHORTEST, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``doc_id, item_id, n_words, covered, n_tiles`` for every item a document covers.

    Words are runs of letters and digits with A-Z folded. Items and documents meet in seeds, runs
    of ``shortest`` words; each pair that meets is tiled, so passages count in any order, and the
    pair is a match if the tiles cover ``coverage`` of the item's words. The items are taken in
    blocks of ``block_bytes``, each of which is broadcast and held against all texts in place, so
    no text and no seed is shuffled and a seed that all documents share costs nothing more.

    Defined results: null and empty texts match nothing, nor do items of fewer than ``shortest``
    words; repeated rows give repeated matches; rows of equal item_id and text are one item; a
    null id is carried.
    """
    found = None
    for block in blocks_of(items, shortest, block_bytes):
        hits = docs.select("doc_id", F.explode(matcher(block, shortest, coverage)(F.col("text"))).alias("m"))
        hits = hits.select("doc_id", "m.*")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = docs.select("doc_id", *[F.lit(None).cast("bigint").alias(f) for f in FIELDS]).where("false")
    return found


def without_leaks(
    docs: DataFrame, items: DataFrame, shortest: int = SHORTEST, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The documents that cover no item; all columns stay as they are."""
    clean: Column | None = None
    for n, block in enumerate(blocks_of(items, shortest, block_bytes)):
        if n:
            docs = stored(docs.where(clean), "clean")
        clean = F.size(matcher(block, shortest, coverage)(F.col("text"))) == 0
    return docs if clean is None else docs.where(clean)
