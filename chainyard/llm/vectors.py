"""Rows with usable vectors, and their numbers inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """Whether a vector is not NULL and holds finite numbers alone."""
    v = F.col(vector).cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & sound, F.lit(False))


def usual_length(rows: DataFrame, vector: str) -> int:
    """The length of most vectors of ``rows`` (of ties the smallest), 0 for no rows."""
    sizes = rows.groupBy(F.size(vector).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), "d").first()
    return 0 if most is None else most.d


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def packed(rows: np.ndarray) -> pa.Array:
    """Each row's numbers as little-endian bytes."""
    size = rows.shape[1] * rows.dtype.itemsize
    data = np.ascontiguousarray(rows).tobytes()
    return pa.array([data[a:a + size] for a in range(0, len(data), size)], pa.binary())


def unpacked(column: pa.Array, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b for b in batches if b.num_rows)
