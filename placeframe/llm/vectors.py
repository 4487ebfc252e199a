"""Helpers for columns of vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is neither null nor zero and holds only finite components."""
    wide = vector.cast("array<double>")
    finite = F.forall(wide, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce(finite & F.exists(wide, lambda x: x != 0), F.lit(False))


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for each length among the lists of a column without nulls."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    length = np.diff(offsets)
    for n in np.unique(length).tolist():
        rows = np.flatnonzero(length == n)
        yield rows, values[offsets[:-1][rows][:, None] + np.arange(n)].astype(np.float64)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The matrix of a column of lists of one length."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(whole, pa.ChunkedArray):
        whole = pa.concat_arrays(whole.chunks)
    if not len(whole):
        return np.zeros((0, 0))
    return next(matrices(whole))[1]
