"""Vector columns as numpy matrices, and products of whole numbers that stay exact."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """The vector is there, has entries, and none is null, NaN or infinite."""
    good = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & good, F.lit(False))


def common_length(df: DataFrame, vector: str) -> int:
    """The length that most vectors have, the longer one of equals; 0 for an empty table."""
    counts = df.groupBy(F.size(vector).alias("d")).count()
    first = counts.orderBy(F.desc("count"), F.desc("d")).first()
    return first["d"] if first else 0


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """Rows of a list column whose lists all have ``dimension`` entries."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of whole numbers: in doubles where these hold every partial sum, else in longs or Python numbers."""
    if not a.size or not b.size:
        return np.zeros((a.shape[0], b.shape[1]), np.int64)
    most = int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    if most < 1 << 63:
        return a.astype(np.int64) @ b.astype(np.int64)
    return a.astype(object) @ b.astype(object)
