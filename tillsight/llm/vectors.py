"""Checks, classes and exact whole-number forms of embedding vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

BIGGEST = 3.4028234663852886e38


def usable(vector: str) -> Column:
    """Whether a vector is neither NULL nor zero and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= BIGGEST))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def valid(rows: DataFrame, *others: str) -> DataFrame:
    """``vec_id, embedding`` (array of float) and other columns of the rows that take part, each once."""
    narrow = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>"), *others)
    return narrow.where(F.col("vec_id").isNotNull() & usable("embedding")).distinct()


def finite(vector: str) -> Column:
    """Whether a vector is not NULL and all its components are finite numbers; it may be empty or zero."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= BIGGEST)), F.lit(False))


def whole(vector: str, scale: int) -> Column:
    """floor(scale * x) of every component x as double; what no long can hold becomes the nearest long."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def whole_matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    """The rows of an array<bigint> column of equal lengths: int64, or exact Python integers.

    Python integers are taken where sums of squares of differences between two rows could leave 62 bits.
    """
    x = np.asarray(column.flatten(), np.int64).reshape(-1, dims)
    return x if small(x) else x.astype(object)


def small(*parts: np.ndarray) -> bool:
    """Whether squares of sums of differences between such rows stay within 62 bits."""
    most = max((max(int(p.max()), -int(p.min())) for p in parts if p.size), default=0)
    dims = max((p.shape[-1] for p in parts if p.size), default=1)
    return 2 * dims * most < 1 << 31


def as_longs(values) -> pa.Array:
    """Whole numbers as BIGINT; one that does not fit is NULL."""
    if isinstance(values, np.ndarray) and values.dtype == np.int64:
        return pa.array(values, pa.int64())
    return pa.array([int(v) if -(1 << 63) <= v < 1 << 63 else None for v in values], pa.int64())
