"""Vector columns as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F


def is_finite(vector: Column) -> Column:
    """Whether a vector and all its components are present and finite numbers."""
    infinite = float("inf")
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    return F.coalesce(vector.isNotNull() & whole, F.lit(False))


def matrix(vectors: pa.Array | pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """Rows of doubles; shorter vectors are filled up with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    offsets = vectors.offsets.to_numpy().astype(np.int64)
    values = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    sizes = np.diff(offsets)
    widest = max(int(sizes.max()) if len(sizes) else 0, width or 0)
    if len(sizes) and (sizes == widest).all():
        return values[offsets[0] : offsets[-1]].reshape(len(sizes), widest)
    rows = np.zeros((len(sizes), widest))
    inside = np.arange(widest) < sizes[:, None]
    rows[inside] = values[offsets[0] : offsets[-1]]
    return rows
