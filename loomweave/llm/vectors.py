"""Vector columns: which rows take part, and batches of them as numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(emb: Column) -> Column:
    """Not null, and no component null or non-finite; an empty vector passes."""
    return emb.isNotNull() & F.forall(emb, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """A list column as a matrix of doubles; shorter rows are filled with zeros up to ``width`` (the longest, if not given)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, width or 0))
    n = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = int(n.max()) if width is None else width
    if (n == width).all():
        return flat.reshape(len(n), width)
    out = np.zeros((len(n), width))
    place = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
    row = np.repeat(np.arange(len(n)), n)
    use = place < width
    out[row[use], place[use]] = flat[use]
    return out

