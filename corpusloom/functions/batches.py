"""Arrow batches in bounded parts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20


def byte_slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Consecutive parts of ``texts`` of up to ``most`` bytes, or of one text. A batch is so many rows, however
    long they are; what is made of a part at once is bounded."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield texts.slice(start, stop - start)
        start = stop
