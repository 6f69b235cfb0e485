"""Moments of all pairs of many columns over their pairwise complete rows.

A block of rows is a matrix with a mask of what is present; four products of these give, for all pairs at
once, the counts, sums, squares and cross products of the rows where both are present. A task keeps one set
of sums, Spark adds the tasks' sums. Wide tables are cut into tiles of columns, so a task's sums stay
bounded; the plan has a few operators whatever the number of columns.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns of a tile; a task holds five sums for each pair of two tiles.
TILE = 256
MOMENTS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def block_moments(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``MOMENTS`` of every column of ``a`` with every column of ``b``; NaN is missing."""
    p, q = ~np.isnan(a), ~np.isnan(b)
    x, y = np.where(p, a, 0.0), np.where(q, b, 0.0)
    p, q = p.astype(float), q.astype(float)
    return np.stack([p.T @ q, x.T @ q, p.T @ y, (x * x).T @ q, p.T @ (y * y), x.T @ y])


def pair_moments(df: DataFrame, values: Sequence[Column]) -> DataFrame:
    """(i, j, n, sx, sy, sxx, syy, sxy) for i <= j: sums over the rows where both of two values are present.

    Values are taken from a middle value of their column, so that sums of squares keep their digits.
    """
    m = len(values)
    middle = df.agg(*[F.percentile_approx(v, 0.5, 1_000).alias(f"m{i}") for i, v in enumerate(values)]).first()
    centre = np.array([middle[f"m{i}"] if middle[f"m{i}"] is not None else 0.0 for i in range(m)])
    tiles = [range(a, min(a + TILE, m)) for a in range(0, m, TILE)]
    rows = df.select(F.array(*values).cast("array<double>").alias("v"))
    schema = "i int, j int, " + ", ".join(f"{s} double" for s in MOMENTS)
    out = None
    for s, left in enumerate(tiles):
        for right in tiles[s:]:

            def work(batches: Iterator[pa.RecordBatch], left=left, right=right) -> Iterator[pa.RecordBatch]:
                total = np.zeros((len(MOMENTS), len(left), len(right)))
                for batch in batches:
                    flat = batch["v"].flatten().to_numpy(zero_copy_only=False)
                    x = flat.reshape(batch.num_rows, m) - centre
                    total += block_moments(x[:, left.start : left.stop], x[:, right.start : right.stop])
                i, j = np.indices(total.shape[1:]).reshape(2, -1)
                i, j = i + left.start, j + right.start
                keep = i <= j
                yield pa.RecordBatch.from_arrays(
                    [pa.array(i[keep].astype("int32")), pa.array(j[keep].astype("int32")),
                     *[pa.array(t.ravel()[keep]) for t in total]], names=["i", "j", *MOMENTS])

            part = rows.mapInArrow(work, schema)
            out = part if out is None else out.unionByName(part)
    return out.groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in MOMENTS])


def correlation(n: str = "n") -> Column:
    """Of the columns of ``pair_moments``; NULL where one side does not vary."""
    def spread(s: str, ss: str) -> Column:
        var = F.col(ss) - F.col(s) * F.col(s) / F.col(n)
        return F.when(var > 1e-13 * F.col(ss), var)

    cross = F.col("sxy") - F.col("sx") * F.col("sy") / F.col(n)
    return F.when(F.col(n) > 1, cross / F.sqrt(spread("sx", "sxx") * spread("sy", "syy")))
