"""Float vectors as whole numbers, and lists of equal or unequal length as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F


def usable(vector: Column) -> Column:
    """True unless the vector is null or holds a null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(~bad, F.lit(False))


def whole(vector: Column, scale: int) -> Column:
    """Components as floor(scale * x), x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))


def largest(vector: Column) -> Column:
    """Greatest absolute value of the scaled components, as double so that it cannot overflow."""
    return F.aggregate(vector, F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x.cast("double"))))


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of ``width`` whole numbers; shorter lists are filled with zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    result = np.zeros((len(sizes), width), np.int64)
    result[np.arange(width)[None, :] < sizes[:, None]] = values
    return result
