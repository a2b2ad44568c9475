"""Documents and their token counts in flat token files without an index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.store import stored

BLOCK_TOKENS = 1 << 16
GROUP = 4096  # blocks whose prefix sums are taken together
DTYPE = "<u2"


def write_token_files(encoded: DataFrame, end: int, block_tokens: int = BLOCK_TOKENS, dtype: str = DTYPE) -> tuple[DataFrame, DataFrame]:
    """Token files made from ``doc_id, ids``, and a list of what was written where.

    Every task writes one file: the ids of its documents, each followed by ``end``, cut into blocks
    of ``block_tokens`` wherever that falls. The files are rows ``file, block, tokens``; the list is
    ``file, doc_no, doc_id``. The scan does not need it.

    Defined results: null ids are a document of no tokens. An id that is null, that equals ``end`` or
    that does not fit ``dtype`` would be read as something else, so it is an error.
    """
    kind = "is_block boolean, file int, no bigint, doc_id bigint, tokens binary"
    names = [f.split()[0] for f in kind.split(", ")]
    least, most = np.iinfo(dtype).min, np.iinfo(dtype).max
    if not least <= end <= most:
        raise ValueError(f"the end of document {end} does not fit {dtype}")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, block, doc, rest = TaskContext.get().partitionId(), 0, 0, np.zeros(0, dtype)

        def rows(is_block, numbers, doc_ids, tokens):
            n = len(numbers)
            columns = [[is_block] * n, pa.array([file] * n, pa.int32()), pa.array(numbers, pa.int64()), doc_ids, pa.array(tokens, pa.binary())]
            return pa.record_batch(columns, names=names)

        for batch in batches:
            ids = batch.column(1)
            # Offsets from the lengths: the values of null lists are not in the flattened ids.
            flat = ids.flatten()
            offsets = np.concatenate([[0], np.cumsum(ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            if flat.null_count:
                raise ValueError("null token id")
            flat = flat.to_numpy(zero_copy_only=False)
            bad = (flat == end) | (flat < least) | (flat > most)
            if bad.any():
                raise ValueError(f"token id {flat[bad][0]} is the end of document or does not fit {dtype}")
            rest = np.concatenate([rest, np.insert(flat.astype(np.int64), offsets[1:], end).astype(dtype)])
            n = len(rest) // block_tokens
            for k in range(n):
                yield rows(True, [block + k], pa.nulls(1, pa.int64()), [rest[k * block_tokens : (k + 1) * block_tokens].tobytes()])
            block, rest = block + n, rest[n * block_tokens :]
            yield rows(False, range(doc, doc + len(ids)), batch.column(0), [None] * len(ids))
            doc += len(ids)
        if len(rest):
            yield rows(True, [block], pa.nulls(1, pa.int64()), [rest.tobytes()])

    written = stored(encoded.select("doc_id", "ids").mapInArrow(write, kind), "tokens")
    files = written.where("is_block").select("file", F.col("no").alias("block"), "tokens")
    return files, written.where("not is_block").select("file", F.col("no").alias("doc_no"), "doc_id")


def scan_separators(files: DataFrame, end: int, dtype: str = DTYPE, group: int = GROUP) -> DataFrame:
    """``file, doc_no, start, n_tokens, closed`` for every document of the token files, given as
    ``file, block, tokens`` with consecutive blocks from 0.

    Each block is searched for ``end`` at once, and only the places found go on. A document may
    begin many blocks before the one it ends in: prefix sums over the blocks (tokens, documents)
    and the last end so far give where each block stands. They are taken within groups of ``group``
    blocks and then over the groups, so a file of any size is no single task's work.

    Defined results: two ends in a row enclose a document of no tokens; what follows the last end
    is a document with ``closed`` false; null or empty blocks hold nothing; a file of no tokens has
    no documents.
    """
    width = np.dtype(dtype).itemsize

    def search(blocks: pa.Array) -> pa.Array:
        sizes, places = [], []
        for block in blocks:
            ids = np.frombuffer(block.as_buffer() or b"", dtype) if block.is_valid and len(block.as_buffer()) >= width else np.zeros(0, dtype)
            sizes.append(len(ids))
            places.append(np.flatnonzero(ids == end).astype(np.int32))
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), pa.array(places, pa.list_(pa.int32()))], names=["n", "ends"]
        )

    found = files.select("file", "block", F.arrow_udf(search, "n long, ends array<int>")(F.col("tokens")).alias("s"))
    blocks = found.select("file", "block", "s.*", F.floor(F.col("block") / group).alias("part"))
    before = Window.partitionBy("file", "part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda column: F.coalesce(column, F.lit(0))
    blocks = blocks.withColumn("start", zero(F.sum("n").over(before)))
    blocks = blocks.withColumn("last", F.col("start") + F.try_element_at("ends", F.lit(-1)))
    blocks = blocks.withColumn("docs", zero(F.sum(F.size("ends")).over(before))).withColumn("seen", F.max("last").over(before))
    blocks = stored(blocks, "ends")
    parts = blocks.groupBy("file", "part").agg(F.sum("n").alias("n"), F.sum(F.size("ends")).alias("docs"), F.max("last").alias("last"))
    earlier = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("part_start", zero(F.sum("n").over(earlier)))
    parts = parts.withColumn("part_docs", zero(F.sum("docs").over(earlier)))
    parts = parts.withColumn("part_seen", F.max(F.col("part_start") + F.col("last")).over(earlier))
    placed = blocks.join(parts.select("file", "part", "part_start", "part_docs", "part_seen"), ["file", "part"])
    first = F.coalesce(F.col("part_start") + F.col("seen"), F.col("part_seen"), F.lit(-1)) + 1
    origin = F.col("part_start") + F.col("start")
    ends = placed.select("file", "ends", first.alias("first"), origin.alias("origin"), (F.col("part_docs") + F.col("docs")).alias("docs_before"), F.posexplode("ends").alias("i", "end"))
    start = F.when(F.col("i") == 0, F.col("first")).otherwise(F.col("origin") + F.get("ends", F.col("i") - 1) + 1)
    closed = ends.select("file", (F.col("docs_before") + F.col("i")).alias("doc_no"), start.alias("start"), (F.col("origin") + F.col("end") - start).alias("n_tokens"), F.lit(True).alias("closed"))
    totals = parts.groupBy("file").agg(F.sum("n").alias("n"), F.sum("docs").alias("doc_no"), (F.max(F.col("part_start") + F.col("last")) + 1).alias("start"))
    rest = totals.select("file", "doc_no", zero(F.col("start")).alias("start"), (F.col("n") - zero(F.col("start"))).alias("n_tokens"), F.lit(False).alias("closed"))
    return closed.unionByName(rest.where("n_tokens > 0"))
