"""Documents to indexed chunks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from corpusloom.functions.vectors import Embedder, hashed_counts, is_usable
from corpusloom.operators.chunking import CHUNK_OVERLAP, INDEX_CHUNK_SIZE, chunked
from corpusloom.operators.shards import DEFAULT_SHARDS, REJECT_SHARD, shard_of

MALFORMED = "vector of %d values where %d finite ones, not all of them 0, are needed"


def index_objects(
    docs: DataFrame,
    keys: list[str],
    text: str = "text",
    embed: Embedder | None = None,
    size: int = INDEX_CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    shards: int = DEFAULT_SHARDS,
    dim: int | None = None,
    carry: list[str] = (),
    observation: Observation | None = None,
    place: Callable[[list[str], int], Column] = shard_of,
    **chunk_options,
) -> DataFrame:
    """Chunks with their vector and shard: ``keys``, ``chunk_ix``, ``context``, ``vector``, ``shard``, ``error``.
    Columns to ``carry`` come after the keys and have no part in the shard. ``place`` gives the shard of
    a key: ``shard_of``, or ``rendezvous_shard`` for an index that may grow.

    One narrow stage from scan to vector: the shard is a value of the row, so placing rows needs no
    shuffle. What a hook fails on goes to the reject shard with the ``error``: a text that cannot be
    encoded (no ``chunk_ix``), a window that cannot be decoded, a chunk that cannot be embedded, and
    one whose vector is not of length ``dim``, not finite or zero. The length must be known, from the
    embedder or as ``dim``, as vectors of several lengths cannot be compared. ``observation``, an
    ``Observation``, gets the numbers of rows that were ``indexed`` and ``refused`` when the result is written.
    """
    embed = embed or hashed_counts()
    dim = dim or getattr(embed, "dim", None)
    if dim is None:
        raise ValueError("the length of the vectors is not known: give dim")
    chunks = chunked(docs, [*keys, *carry], text, size, overlap, **chunk_options).withColumnRenamed("chunk", "context")
    names = [*keys, *carry, "chunk_ix", "context", "error"]
    if hasattr(embed, "checked"):
        embedded = chunks.select(*names, embed.checked(F.col("context")).alias("_e"))
        embedded = embedded.select(*names[:-1], F.coalesce("error", "_e.error").alias("error"), "_e.vector")
    else:
        embedded = chunks.select(*names, embed(F.col("context")).alias("vector"))
    good = F.col("error").isNull() & is_usable(F.col("vector"), dim)
    shard = F.when(good, place([*keys, "chunk_ix"], shards)).otherwise(REJECT_SHARD)
    malformed = F.format_string(MALFORMED, F.coalesce(F.size("vector"), F.lit(-1)), F.lit(dim))
    error = F.when(~good, F.coalesce("error", malformed)).alias("error")
    objects = embedded.select(*names[:-1], "vector", shard.alias("shard"), error)
    if observation is not None:
        refused = F.col("shard") == REJECT_SHARD
        objects = objects.observe(observation, F.count_if(~refused).alias("indexed"), F.count_if(refused).alias("refused"))
    return objects


def accepted(objects: DataFrame) -> DataFrame:
    return objects.where(F.col("shard") != REJECT_SHARD)


def rejected(objects: DataFrame) -> DataFrame:
    """Texts and chunks that could not be indexed, with the error."""
    return objects.where(F.col("shard") == REJECT_SHARD)
