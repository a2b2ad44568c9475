"""Byte-level BPE: ranked merges over the bytes of distinct words, and decoding."""

from __future__ import annotations

import base64
import heapq
import json
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.store import packed

WORDS_KEPT = 400_000  # distinct words whose ids a task remembers
BUCKETS = 1 << 16


@cache
def read_ranks(path: str) -> dict[bytes, int]:
    """Pieces and their ranks from a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: the pair of lowest rank is merged, the leftmost of equal ones first."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > 64:
        return _merge_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    pairs = [ranks.get(a + b, 1 << 40) for a, b in zip(parts, parts[1:])]
    while pairs and (low := min(pairs)) < 1 << 40:
        i = pairs.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 40)
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], 1 << 40)
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap over linked pieces, for words of any length."""
    n = len(word)
    end = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, j, to = heapq.heappop(heap)
        if not alive[i] or end[i] != j or j >= n or not alive[j] or end[j] != to:
            continue
        alive[j], end[i] = False, to
        if to < n:
            before[to] = i
            if (r := ranks.get(word[i : end[to]])) is not None:
                heapq.heappush(heap, (r, i, to, end[to]))
        if (p := before[i]) >= 0 and (r := ranks.get(word[p:to])) is not None:
            heapq.heappush(heap, (r, p, i, to))
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


_words: dict[str, dict[str, bytes]] = {}


class Tokenizer:
    """Column functions for one rank file, which every executor gets as a Spark file."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        spark.sparkContext.addFile(path)
        self.name, self.pattern = path.rpartition("/")[2], pattern

    def encoder(self):
        """Text to ``array<int>``; a null text is empty."""
        return F.arrow_udf(self._encode(), "array<int>")

    def round_trip(self):
        """Text to its ids and the bytes that these decode to, in one pass over the text."""
        encode, decode = self._encode(), self._decode()

        def both(texts: pa.Array) -> pa.Array:
            ids = encode(texts)
            return pa.StructArray.from_arrays([ids, decode(ids)], names=["ids", "decoded"])

        return F.arrow_udf(both, "ids array<int>, decoded binary")

    def _encode(self):
        name, pattern = self.name, self.pattern

        def encode(texts: pa.Array) -> pa.Array:
            import regex

            ranks = read_ranks(SparkFiles.get(name))
            find, known = regex.compile(pattern).findall, _words.setdefault(name + pattern, {})
            ids, sizes = [], [0]
            for text in texts:
                words = find(text.as_py() or "")
                for word in set(words):
                    if word not in known:
                        known[word] = np.array(merge(word.encode(), ranks), np.int32).tobytes()
                row = b"".join([known[w] for w in words])
                ids.append(row)
                sizes.append(sizes[-1] + len(row) // 4)
                if len(known) > WORDS_KEPT:
                    known.clear()
            flat = pa.Array.from_buffers(pa.int32(), sizes[-1], [None, pa.py_buffer(b"".join(ids))])
            return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), flat)

        return encode

    def decoder(self):
        """``array<int>`` to the bytes it stands for: the pieces, one after the other."""
        return F.arrow_udf(self._decode(), "binary")

    def _decode(self):
        name = self.name

        def decode(rows: pa.Array) -> pa.Array:
            pieces = _pieces(SparkFiles.get(name))
            rows = rows.fill_null([]) if rows.null_count else rows
            data = pieces.take(rows.flatten())
            ends = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1] if len(data) else np.zeros(1, np.int64)
            offsets = np.asarray(rows.offsets).astype(np.int64)
            cuts = ends[offsets - offsets[0]] - ends[0]
            body = data.buffers()[2] if len(data) else pa.py_buffer(b"")
            if len(data) and ends[0]:
                body = body.slice(int(ends[0]))
            return pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(cuts.tobytes()), body]).cast(pa.binary())

        return decode


@cache
def _pieces(path: str) -> pa.Array:
    ranks = read_ranks(path)
    by_id = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        by_id[rank] = piece
    return pa.array(by_id, pa.large_binary())


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """The documents with ``ids`` (array of int) and ``decoded`` (bytes of the ids).

    Texts are cut by ``pattern`` and every distinct word is merged by rank once per task, which
    remembers up to ``WORDS_KEPT`` of them and starts anew beyond. Special tokens are ordinary
    text. Defined results: a null or empty text has no ids and decodes to no bytes; nothing else
    of a row is looked at. The work is one narrow stage; no row moves.
    """
    found = Tokenizer(docs.sparkSession, path, pattern).round_trip()(F.col("text"))
    own = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ("ids", "decoded")]
    return packed(docs, "text").select("row", found.alias("_found")).select(*own, "_found.ids", "_found.decoded")


def rank_map(path: str) -> Column:
    """The ranks as a literal: ``BUCKETS`` small maps by the hash of a piece in hexadecimal."""
    spark = SparkSession.active()
    rows = spark.createDataFrame([(piece.hex().upper(), rank) for piece, rank in read_ranks(path).items()], "piece string, rank int")
    maps: list[dict] = [{} for _ in range(BUCKETS)]
    for bucket, piece, rank in rows.select(F.pmod(F.xxhash64("piece"), F.lit(BUCKETS)), "piece", "rank").collect():
        maps[bucket][piece] = rank
    return F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")


def fold_merges(word: Column, ranks: Column) -> Column:
    """Ids of a word by higher-order functions alone: a fold over the bytes of the word in which
    every step merges the adjacent pair of lowest rank in the literal rank map."""
    rank = lambda piece: F.element_at(F.get(ranks, F.pmod(F.xxhash64(piece), F.lit(BUCKETS)).cast("int")), piece)
    bytes_ = F.regexp_extract_all(F.hex(F.encode(word, "UTF-8")), F.lit("(..)"), 1)

    def step(parts: Column, _: Column) -> Column:
        pairs = F.zip_with(F.slice(parts, 1, F.size(parts) - 1), F.slice(parts, 2, F.size(parts) - 1), lambda a, b: rank(F.concat(a, b)))
        at = lambda p: F.array_position(p, F.array_min(p)).cast("int")
        merged = lambda i: F.concat(
            F.slice(parts, F.lit(1), i - 1), F.array(F.concat(F.get(parts, i - 1), F.get(parts, i))), F.slice(parts, i + 2, F.size(parts))
        )
        done = lambda p: F.when(F.array_min(p).isNull(), parts).otherwise(merged(at(p)))
        return F.when(F.size(parts) < 2, parts).otherwise(F.get(F.transform(F.array(pairs), done), F.lit(0)))

    folded = F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(bytes_), F.lit(1))), bytes_, step)
    return F.transform(folded, rank)
