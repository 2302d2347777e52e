"""Vectors of a table: which take part in a comparison, and as what."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F


def usable(column: str = "vector") -> F.Column:
    """Not null, not zero, every component a finite number."""
    odd = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd & F.exists(column, lambda x: x != 0), F.lit(False))


def matrix(column) -> np.ndarray:
    """A list column of equally long vectors as rows of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def unit(rows: np.ndarray) -> np.ndarray:
    """The rows with length 1, also where squares would overflow or vanish."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True) if len(rows) else rows
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cosine of each row of ``a`` and the same row of ``b``, both of length 1."""
    return np.einsum("ij,ij->i", a, b)
