"""Vectors in tables."""

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def is_usable(embedding: Column) -> Column:
    """Not null or empty, all components finite, not all zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def by_length(column) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for each length that occurs in an Arrow list column without nulls."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    found = []
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        found.append((rows, flat[starts[rows][:, None] + np.arange(length)]))
    return found


def unit(matrix: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; very large or small rows are scaled first."""
    matrix = matrix.astype(np.float64)
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
