"""Rows of whole-number vectors, and blocks of them as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def is_finite(vector: str) -> Column:
    """A vector that is there and holds neither nulls nor values that aren't finite."""
    def one(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    return F.coalesce(F.forall(F.col(vector), one), F.lit(False))


def floored(vector: str, factor: int, offset: int = 0) -> Column:
    """Every component c as floor(factor * c) + offset, c as double."""
    return F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * F.lit(float(factor))) + F.lit(offset))


def matrix(lists: pa.Array, width: int, fill: int = 0) -> np.ndarray:
    """Rows of a list array as a matrix of whole numbers; what a shorter row lacks is ``fill``."""
    bounds, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    sizes = np.diff(bounds)
    if (sizes == width).all():
        return flat[bounds[0]:bounds[-1]].reshape(len(sizes), width)
    out = np.full((len(sizes), width), fill, np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(bounds[0], bounds[-1]) - bounds[:-1][row]] = flat[bounds[0]:bounds[-1]]
    return out


def packed(rows: np.ndarray) -> bytes:
    return np.ascontiguousarray(rows, "<i8").tobytes()


def unpacked(rows: bytes, width: int, n: int | None = None) -> np.ndarray:
    """Rows from :func:`packed`; ``n`` tells how many there are where ``width`` may be 0."""
    flat = np.frombuffer(rows, "<i8")
    return flat.reshape(n if n is not None else -1, width)


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows, as long as they fit in 64 bits."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    largest = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if largest < 2.0 ** 53:  # sums of doubles are exact below
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T
