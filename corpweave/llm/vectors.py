"""Vector columns as matrices, read from the flat buffers of Arrow lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def finite_matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, vectors in double precision) for every length that occurs in a list column.

    Rows that are null, empty or hold null or non-finite entries are in none of them.
    """
    lengths = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().cast(pa.float64())
    values = pc.fill_null(values, float("nan")).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    wrong = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    usable = (lengths > 0) & (wrong[ends] == wrong[ends - lengths])
    for length in np.unique(lengths[usable]).tolist():
        rows = np.flatnonzero(usable & (lengths == length))
        yield rows, values[(ends[rows] - length)[:, None] + np.arange(length)]


def packed(column: pa.Array, kind: type) -> np.ndarray:
    """Binary values of one length as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)
