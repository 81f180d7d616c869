"""Integer vectors out of an array column."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Largest absolute component after scaling: products of two vectors of up to
#: 512 components and squared distances then fit a 64-bit integer.
MAX_COMPONENT = 1 << 26


def whole(column: str, dims: int) -> Column:
    """True for arrays of exactly ``dims`` components, none null or non-finite."""
    finite = lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x.cast("double"))
    return F.coalesce((F.size(column) == dims) & F.forall(column, finite), F.lit(False))


def scaled(values: pa.Array, dims: int, factor: int) -> np.ndarray:
    """``floor(factor * x)`` of every component, x taken as a double; one row a vector."""
    flat = values.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(values), dims)
    found = np.floor(factor * flat)
    if found.size and np.abs(found).max() > MAX_COMPONENT:
        raise ValueError(f"a scaled component is beyond {MAX_COMPONENT}: its products would not be exact")
    return found.astype(np.int64)


def matrix(values: pa.Array, dims: int) -> np.ndarray:
    """The rows of a column of equally long integer lists."""
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(values), dims)


def lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The rows of a matrix as a list column."""
    rows, dims = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * dims), pa.array(values.ravel(), kind))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices: in floating
    point where every partial sum is a whole number below 2**53."""
    top = lambda m: int(np.abs(m).max(initial=0))
    if a.shape[1] * top(a) * top(b) < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T
