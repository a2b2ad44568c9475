"""Overlapping token windows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.batches import byte_slices
from corpusloom.functions.text import error_text, split_words

# --- fixed values -------------------------------------------------------------------------------
DEFAULT_CHUNK_SIZE = 128
INDEX_CHUNK_SIZE = 64
CHUNK_OVERLAP = 20
DEFAULT_TOKEN_LIMIT = 8192
# ------------------------------------------------------------------------------------------------

DECODED_WINDOWS = 256  # whose texts are handed on at once


def window_shape(size: int, overlap: int, limit: int = DEFAULT_TOKEN_LIMIT) -> tuple[int, int]:
    """Size after the tokenizer's limit, and step. The windows must move forward."""
    size = min(size, limit)
    if overlap < 0 or size <= overlap:
        raise ValueError(f"chunk size {size} must exceed the overlap {overlap}")
    return size, size - overlap


def token_limit(tokenizer: object) -> int:
    """The longest window a tokenizer's model takes."""
    return getattr(tokenizer, "model_max_length", DEFAULT_TOKEN_LIMIT)


def window_count(n_tokens: Column, size: int, step: int) -> Column:
    """How many windows cover ``n_tokens``: none for 0, and no tail inside its predecessor."""
    beyond = F.greatest(n_tokens - size, F.lit(0))
    return F.when(n_tokens > 0, F.ceil(beyond / step) + 1).otherwise(0).cast("int")


def token_windows(tokens: Column, size: int, step: int, shape: Callable[[Column], Column] = lambda window: window) -> Column:
    """Array of the overlapping windows over a token array, each passed through ``shape``; null for
    no tokens."""
    last = window_count(F.size(tokens), size, step) - 1
    return F.when(
        F.size(tokens) > 0,
        F.transform(F.sequence(F.lit(0), last), lambda i: shape(F.slice(tokens, i * step + 1, size))),
    )


def join_words(window: Column) -> Column:
    return F.array_join(window, " ")


def chunk_documents(
    docs: DataFrame,
    keys: list[str],
    text: str = "text",
    size: int = DEFAULT_CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    tokenize: Callable[[Column], Column] = split_words,
    detokenize: Callable[[Column], Column] | None = None,
    limit: int = DEFAULT_TOKEN_LIMIT,
) -> DataFrame:
    """One row per window: the document's ``keys``, ``chunk_ix`` and the window's text ``chunk``.

    A narrow job: every document is cut where it lies, with no shuffle. The tokens are computed in
    a projection of their own, so that the windows slice one array and never tokenise again. Word
    windows are joined as they are sliced; a ``detokenize`` of one's own, which may run in Python,
    gets the sliced tokens as rows. Texts and windows that a hook fails on are left out, as are
    documents without tokens; ask ``refused_chunks`` and ``empty_documents`` for these.
    """
    return chunked(docs, keys, text, size, overlap, tokenize, detokenize, limit).where("error is null").drop("error")


def refused_chunks(docs: DataFrame, keys: list[str], text: str = "text", **options) -> DataFrame:
    """What ``chunk_documents`` leaves out because a hook failed: ``keys``, ``chunk_ix``, ``error``. Without
    ``chunk_ix`` the whole text could not be encoded, with it one window could not be decoded."""
    return chunked(docs, keys, text, **options).where("error is not null").drop("chunk")


def chunked(
    docs: DataFrame,
    keys: list[str],
    text: str = "text",
    size: int = DEFAULT_CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    tokenize: Callable[[Column], Column] = split_words,
    detokenize: Callable[[Column], Column] | None = None,
    limit: int = DEFAULT_TOKEN_LIMIT,
) -> DataFrame:
    """Windows and refusals in one pass: ``keys``, ``chunk_ix``, ``chunk``, ``error``."""
    size, step = window_shape(size, overlap, min(limit, getattr(tokenize, "token_limit", limit)))
    nothing = F.lit(None).cast("string")
    if detokenize is None:
        tokens = docs.select(*keys, tokenize(F.col(text)).alias("_tokens"))
        windows = token_windows(F.col("_tokens"), size, step, join_words)
        return tokens.select(*keys, F.posexplode(windows).alias("chunk_ix", "chunk")).withColumn("error", nothing)
    if hasattr(tokenize, "checked"):
        tokens = docs.select(*keys, tokenize.checked(F.col(text)).alias("_t")).select(*keys, F.col("_t.ids").alias("_tokens"), "_t.error")
    else:
        tokens = docs.select(*keys, tokenize(F.col(text)).alias("_tokens"), nothing.alias("error"))
    # A refused text goes on as one row without tokens.
    refused = F.array(F.lit(None).cast(tokens.schema["_tokens"].dataType))
    each = F.when(F.col("error").isNotNull(), refused).otherwise(token_windows(F.col("_tokens"), size, step))
    windows = tokens.select(*keys, "error", F.posexplode(each).alias("chunk_ix", "_window"))
    windows = windows.withColumn("chunk_ix", F.when(F.col("error").isNull(), F.col("chunk_ix")))
    if hasattr(detokenize, "checked"):
        decoded = windows.withColumn("_d", detokenize.checked(F.col("_window")))
        return decoded.select(*keys, "chunk_ix", F.col("_d.text").alias("chunk"), F.coalesce("error", "_d.error").alias("error"))
    decoded = windows.withColumn("chunk", detokenize(F.col("_window")))
    failed = F.when(F.col("chunk").isNull(), F.lit("not decoded"))
    return decoded.select(*keys, "chunk_ix", "chunk", F.coalesce("error", failed).alias("error"))


def chunk_counts(
    docs: DataFrame,
    keys: list[str],
    text: str = "text",
    size: int = DEFAULT_CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    tokenize: Callable[[Column], Column] = split_words,
    limit: int = DEFAULT_TOKEN_LIMIT,
) -> DataFrame:
    """Tokens and windows per document, computed from the token count alone."""
    size, step = window_shape(size, overlap, min(limit, getattr(tokenize, "token_limit", limit)))
    counted = docs.select(*keys, F.greatest(F.size(tokenize(F.col(text))), F.lit(0)).alias("n_tokens"))
    return counted.withColumn("n_chunks", window_count(F.col("n_tokens"), size, step))


def empty_documents(docs: DataFrame, keys: list[str], text: str = "text", tokenize=split_words) -> DataFrame:
    """Documents that give no chunk. Decided per row, so no anti join is needed."""
    return docs.where(F.greatest(F.size(tokenize(F.col(text))), F.lit(0)) == 0).select(*keys)


def tokenizer_hooks(make_tokenizer: Callable[[], object]):
    """``tokenize`` and ``detokenize`` columns around a user's subword tokenizer.

    ``make_tokenizer`` runs once per Python worker, and once on the driver for the longest window its
    model takes (``model_max_length``, if it has that). It returns an object with ``encode(text)`` to a
    list of ids and ``decode(ids)``. Each of the two columns also comes as ``checked``, a struct of
    the value and of the ``error`` that the tokenizer raised, if it did. A null text has no tokens.
    """

    def attempts(call, values, empty):
        found, errors = [], []
        for value in values:
            try:
                found.append(empty if value is None else call(value))
                errors.append(None)
            except Exception as e:
                found.append(empty)
                errors.append(error_text(e))
        return found, errors

    nothing = pa.array([], pa.int32())

    @F.arrow_udf("ids array<int>, error string")
    def encode_checked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = make_tokenizer()
        encode = lambda text: pa.array(list(tokenizer.encode(text)), pa.int32())
        # Ids are handed on for a MiB of texts at a time, four bytes each and not as Python's numbers.
        for part in (part for texts in batches for part in byte_slices(texts)):
            ids, errors = attempts(encode, part.to_pylist(), nothing)
            starts = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
            lists = pa.ListArray.from_arrays(starts, pa.concat_arrays([nothing, *ids]))
            yield pa.StructArray.from_arrays([lists, pa.array(errors, pa.string())], names=["ids", "error"])

    @F.arrow_udf("text string, error string")
    def decode_checked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = make_tokenizer()
        for windows in batches:
            ids, ends, known = windows.values.to_numpy(zero_copy_only=False), windows.offsets.to_numpy(), windows.is_valid().to_numpy(zero_copy_only=False)
            for start in range(0, len(windows), DECODED_WINDOWS):
                rows = range(start, min(start + DECODED_WINDOWS, len(windows)))
                part = (ids[ends[i] : ends[i + 1]].tolist() if known[i] else None for i in rows)
                texts, errors = attempts(tokenizer.decode, part, None)
                yield pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(errors, pa.string())], names=["text", "error"])

    encode = lambda text: encode_checked(text)["ids"]
    decode = lambda window: decode_checked(window)["text"]
    encode.checked, decode.checked = encode_checked, decode_checked
    encode.token_limit = token_limit(make_tokenizer())
    return encode, decode
