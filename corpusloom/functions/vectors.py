"""Embedding functions and vector similarity."""

from __future__ import annotations

from collections.abc import Callable, Iterator

try:
    from _md5 import md5  # starts in a third of the time that OpenSSL's takes
except ModuleNotFoundError:
    from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.batches import byte_slices
from corpusloom.functions.text import error_text

DEFAULT_DIM = 256
VECTOR_TYPE = T.ArrayType(T.FloatType())

Embedder = Callable[[Column], Column]


def hashed_counts(dim: int = DEFAULT_DIM) -> Embedder:
    """The default embedder: counts of lower-cased words per hash bucket.

    It is lexical, not semantic. A word's bucket is the first 32 bits of its md5, modulo ``dim``.
    The vector is left unscaled: cosine search does not need unit length, and whole-number counts
    make every dot product exact, so equal matches tie whichever task scores them. Texts are split and
    counted a MiB at a time, hashing every distinct word of it only once.
    """

    def weigh(texts: pa.Array) -> np.ndarray:
        rows = len(texts)
        words = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(texts))
        owner = pc.list_parent_indices(words).to_numpy()
        flat = words.flatten().dictionary_encode()
        vocabulary = flat.dictionary.cast(pa.binary())
        digests = b"".join([md5(word, usedforsecurity=False).digest() for word in vocabulary.to_numpy(zero_copy_only=False)])
        buckets = np.frombuffer(digests, dtype=">u4")[::4].astype(np.int64) % dim
        # Blank text splits into one empty word, which does not count.
        counted = (pc.binary_length(vocabulary).to_numpy() > 0).astype(np.float32)
        index = flat.indices.to_numpy()
        if not len(index):
            buckets, counted, owner, index = (np.zeros(1, dtype=np.int64),) * 4
        weights = np.bincount(owner * dim + buckets[index], weights=counted[index], minlength=rows * dim)
        return weights[: rows * dim].astype(np.float32)

    @F.arrow_udf(VECTOR_TYPE)
    def count_buckets(texts: pa.Array) -> pa.Array:
        weights = np.zeros(len(texts) * dim, dtype=np.float32)
        at = 0
        for part in byte_slices(texts):
            weights[at * dim : (at + len(part)) * dim] = weigh(part)
            at += len(part)
        starts = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * dim)
        return pa.ListArray.from_arrays(starts, pa.array(weights))

    def embed(text: Column) -> Column:
        return count_buckets(F.lower(F.coalesce(text, F.lit(""))))

    embed.dim = dim
    return embed


def model_embedder(make_model: Callable[[], Callable[[list[str]], object]], batch: int = 100, dim: int | None = None) -> Embedder:
    """Embedder around a user's model.

    ``make_model`` runs once per Python worker and returns a function from a list of texts to a
    list of vectors, of length ``dim`` where that is given. A batch that fails is tried text by text,
    and a text that still fails gets a null vector. As ``checked`` the embedder gives a struct of the
    vector and the ``error`` raised, which the index build hands out with the reject.
    """

    @F.pandas_udf("vector array<float>, error string")
    def encode(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = make_model()

        def one(text):
            try:
                return np.asarray(model([text])[0], dtype=np.float32), None
            except Exception as e:
                return None, error_text(e)

        for series in texts:
            values = series.tolist()
            known = [i for i, text in enumerate(values) if text is not None]
            rows: list[tuple] = [(None, None)] * len(values)
            for start in range(0, len(known), batch):
                part = known[start : start + batch]
                try:
                    encoded = [(np.asarray(v, dtype=np.float32), None) for v in model([values[i] for i in part])]
                    if len(encoded) != len(part):
                        raise ValueError("one vector per text expected")
                except Exception:
                    encoded = [one(values[i]) for i in part]
                for i, row in zip(part, encoded):
                    rows[i] = row
            yield pd.DataFrame({name: pd.Series([r[i] for r in rows], dtype=object) for i, name in enumerate(("vector", "error"))})

    def embed(text: Column) -> Column:
        return encode(text)["vector"]

    embed.checked, embed.dim = encode, dim
    return embed


def squared_norm(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))


def unit_length(vector: Column) -> Column:
    """The vector scaled to length 1, in double; null for the zero vector."""
    # The scaling is the aggregate's last step, so the norm is summed once and not per element.
    return F.aggregate(
        vector,
        F.lit(0.0),
        lambda s, x: s + x.cast("double") * x.cast("double"),
        lambda s: F.when(s > 0, F.transform(vector, lambda x: x.cast("double") / F.sqrt(s))),
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two array columns; null when either is the zero vector."""
    dot = F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda s, x: s + x,
    )
    norms = F.sqrt(squared_norm(a) * squared_norm(b))
    return F.when(norms > 0, dot / norms)


def distance_of(cos: Column) -> Column:
    return F.lit(1.0) - cos


def certainty_of(distance: Column) -> Column:
    return F.lit(1.0) - distance / 2


def is_usable(vector: Column, dim: int | None = None) -> Column:
    """Whether a vector can be indexed: present, of the expected length, all of it finite numbers
    and not all of them 0, as a zero vector has no direction."""
    right = F.size(vector) > 0 if dim is None else F.size(vector) == dim
    for bad in ("NaN", "Infinity", "-Infinity"):
        # A null element without a match makes the test null, which counts as unusable.
        right = right & ~F.array_contains(vector, F.lit(bad).cast("float"))
    return F.coalesce(right & F.exists(vector, lambda x: x != 0), F.lit(False))
