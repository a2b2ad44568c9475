"""Karp-Rabin hashes of the words of many texts at once, on the Arrow bytes of a column.

A chunk of texts is one run of bytes. Prefix sums of ``byte * B**position`` modulo 2**64 give the
polynomial hash of any word as one difference, which is then mixed. All of it is array work.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1
CHUNK_BYTES = 1 << 19


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all others."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(BASE, -1, 1 << 64)
    up, down = np.full(n, BASE, U), np.full(n, inverse, U)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for at least ``n`` positions."""
    return _powers(1 << max(CHUNK_BYTES + 1, n).bit_length())


def byte_classes(is_word, fold) -> tuple[np.ndarray, np.ndarray]:
    """Tables over the 256 byte values: whether it belongs to a word, and what it counts as."""
    return np.array([is_word(b) for b in range(256)]), np.array([fold(b) + 1 for b in range(256)], U)


def chunks(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, slice]]:
    """Bytes and row offsets of runs of rows of about ``CHUNK_BYTES`` each; nulls are empty."""
    texts = texts.fill_null("").cast(pa.large_string()) if texts.type != pa.large_string() else texts.fill_null("")
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1)
        to = min(to, n)
        yield data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], slice(at, to)
        at = to


def word_hashes(data: np.ndarray, offsets: np.ndarray, classes: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order, and where each text's words begin (one more entry at the end)."""
    is_word, value = classes
    if not len(data):
        return np.zeros(0, U), np.zeros(len(offsets), np.int64)
    word = is_word[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, U)
    np.cumsum(value[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U)), np.searchsorted(starts, offsets)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Rolling hash of each run of ``size`` words; one entry for each possible start."""
    n = max(0, len(words) - size + 1)
    out = np.zeros(n, U)
    for k in range(size):
        out = out * U(BASE) + words[k : k + n]
    return mix(out)
