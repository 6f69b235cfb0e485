"""Whitening of embeddings on the leading components of their covariance.

Entries become whole numbers, so sums and centred products are exact sums of longs: the same in any order
and after any retried task. Only sums of dimensions x dimensions reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.llm.common import arrow_map, empty, need
from maskloom.llm.eigen import leading
from maskloom.llm.vectors import common_length, exact_product, finite, matrix

SCALE, SHIFT = 64, 1_000_000
#: Scaled entries are held to plus or minus this, so that squares of differences can be split into two longs.
FAR = float(1 << 40)
#: Sums travel as (s >> PART, s & (2^PART - 1)).
PART = 40
#: Components whose eigenvalue is not above this share of the largest have no direction and are left out.
RANK = 1e-12
OUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
       "identity_error double")


def whole(column, dimension: int) -> np.ndarray:
    c = matrix(column, dimension).astype(np.float64)
    return np.clip(np.floor(c * SCALE), -FAR, FAR).astype(np.int64) + SHIFT


def parts(values: list[int]) -> tuple[list[int], list[int]]:
    return [v >> PART for v in values], [v & ((1 << PART) - 1) for v in values]


def sums(rows: DataFrame, dimension: int) -> tuple[int, list[int]]:
    """Rows and the sum of each dimension."""

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        n, total = 0, [0] * dimension
        for batch in batches:
            x = whole(batch["vector"], dimension)
            n, total = n + len(x), [a + b for a, b in zip(total, x.sum(axis=0).tolist())]
        high, low = parts([n, *total])
        yield {"i": range(-1, dimension), "high": high, "low": low}

    found = arrow_map(rows.select("vector"), work, "i int, high long, low long")
    summed = {r["i"]: (r["high"] << PART) + r["low"] for r in
              found.groupBy("i").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()}
    return summed.get(-1, 0), [summed.get(i, 0) for i in range(dimension)]


def covariance(rows: DataFrame, n: int, total: list[int]) -> np.ndarray:
    """Divisor ``n``. Products are taken of distances from the whole part of the mean; its remainder is exact."""
    dimension = len(total)
    middle = np.array([s // n for s in total], np.int64)
    upper = np.triu_indices(dimension)

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        products = [0] * len(upper[0])
        for batch in batches:
            y = whole(batch["vector"], dimension) - middle
            products = [a + b for a, b in zip(products, exact_product(y.T, y)[upper].tolist())]
        high, low = parts(products)
        yield {"i": upper[0], "j": upper[1], "high": high, "low": low}

    found = arrow_map(rows.select("vector"), work, "i int, j int, high long, low long")
    rest = [s - n * m for s, m in zip(total, middle.tolist())]
    out = np.zeros((dimension, dimension))
    for r in found.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect():
        i, j = r["i"], r["j"]
        out[i, j] = out[j, i] = (n * ((r["high"] << PART) + r["low"]) - rest[i] * rest[j]) / (n * n)
    return out


def squares(y: np.ndarray, n: int, rest: list[int]) -> list[int | None]:
    """Sum of (n y - rest)^2 over the dimensions, null where a long can't hold it."""
    most = n * (int(np.abs(y).max(initial=0)) + 1)
    if most * most * y.shape[1] < 1 << 63:
        return ((n * y - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
    exact = ((n * y.astype(object) - np.array(rest, object)) ** 2).sum(axis=1)
    return [v if v < 1 << 63 else None for v in exact]


def whiten(vectors: DataFrame, *, components: int = 32) -> DataFrame:
    """A row for each vector and component, numbered from 1 by falling eigenvalue.

    ``vectors`` has ``vec_id`` and ``embedding``; other columns are ignored. Rows whose vector is null, empty,
    or holds null or non-finite entries are dropped, and so are vectors of another length than most have.
    Each remaining row counts and is returned, whatever its ``vec_id`` (null or repeated). Components without
    variance are left out: equal vectors give no rows. ``identity_error`` is measured: the largest entry of
    the covariance of the whitened vectors minus the identity.
    """
    spark = vectors.sparkSession
    rows = need(vectors, "vec_id", "embedding").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector")).where(finite(F.col("vector")))
    dimension = common_length(rows, "vector")
    if not dimension:
        return empty(spark, OUT)
    rows = rows.where(F.size("vector") == dimension)
    n, total = sums(rows, dimension)
    spread = covariance(rows, n, total)
    values, directions = leading(spread, components)
    kept = int((values > RANK * max(values[0], 0.0)).sum())
    if not kept:
        return empty(spark, OUT)
    explained = values[:kept] / np.trace(spread)
    middle = np.array([s // n for s in total], np.int64)
    rest = [s - n * m for s, m in zip(total, middle.tolist())]
    shipped = spark.sparkContext.broadcast((middle, np.array([r / n for r in rest]),
                                            directions[:, :kept] / np.sqrt(values[:kept])))

    def project(column) -> tuple[np.ndarray, np.ndarray]:
        centre, remainder, axes = shipped.value
        y = whole(column, dimension) - centre
        return y, (y - remainder) @ axes

    def measure(batches: Iterator[dict]) -> Iterator[dict]:
        products, mean = np.zeros((kept, kept)), np.zeros(kept)
        for batch in batches:
            _, w = project(batch["vector"])
            products, mean = products + w.T @ w, mean + w.sum(axis=0)
        i, j = np.indices((kept, kept + 1)).reshape(2, -1)
        yield {"i": i, "j": j, "s": np.column_stack([products, mean]).ravel()}

    seen = np.zeros((kept, kept + 1))
    for r in arrow_map(rows.select("vector"), measure, "i int, j int, s double").groupBy("i", "j").agg(
            F.sum("s").alias("s")).collect():
        seen[r["i"], r["j"]] = r["s"] / n
    error = float(np.abs(seen[:, :kept] - np.outer(seen[:, kept], seen[:, kept]) - np.eye(kept)).max())

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            y, w = project(batch["vector"])
            m = len(w)
            yield {
                "vec_id": batch["vec_id"].take(np.repeat(np.arange(m), kept)),
                "component": np.tile(np.arange(1, kept + 1, dtype=np.int32), m), "n": np.full(m * kept, n),
                "deviation": [v for v in squares(y, n, rest) for _ in range(kept)], "whitened": w.ravel(),
                "explained": np.tile(explained, m), "identity_error": np.full(m * kept, error),
            }

    return arrow_map(rows, work, OUT)
