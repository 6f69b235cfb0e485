"""Projection of mixed columns with any number of modalities.

The encoded matrix of ``encode`` (standardised numbers, scaled indicators) is never written out: a row has one
modality per category, so a product with it is a look-up of one vector per category, and a product with its
transpose is a sum per modality. Modalities are rows of a table, joined and grouped like any other; nothing
per modality reaches the driver or a query plan. Components come from a randomised range finder: a few
passes of both products from random vectors, made orthonormal through their small Gram matrix, and the
eigenvectors of the small covariance at the end.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import sqrt

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom.functions.sizing import lookup
from maskloom.functions.uniform import uniform
from maskloom.functions.validation import col, is_number, is_time
from maskloom.operators.processors.datetime import to_seconds
from maskloom.operators.profile import modality_counts
from maskloom.operators.synthesis.encode import Feature, fit_encoder
from maskloom.session import materialize

OVERSAMPLE, PASSES = 8, 6


def total(vectors: Sequence[Column], width: int) -> Column:
    """Sum of array columns; a null array (a modality that was not fitted) adds nothing."""
    parts = [F.coalesce(v, F.array_repeat(F.lit(0.0), width)) for v in vectors]
    out = parts[0]
    for part in parts[1:]:
        out = F.zip_with(out, part, lambda a, b: a + b)
    return out


def combined(vector: Column, matrix: np.ndarray) -> Column:
    """The array times a small matrix, as one expression per column of it."""
    size = matrix.shape[0]
    return F.array(*[
        sum((vector[i] * float(matrix[i, j]) for i in range(1, size)), vector[0] * float(matrix[0, j]))
        for j in range(matrix.shape[1])])


@dataclass(frozen=True)
class SparseSpace:
    """Loadings: ``levels`` (column, level, factor, loading) as a table, those of numbers as a small matrix."""

    numbers: tuple[Feature, ...]
    categories: tuple[str, ...]
    levels: DataFrame
    loadings: np.ndarray
    shift: tuple[float, ...]
    explained: np.ndarray

    def place(self, df: DataFrame, row_key: str) -> DataFrame:
        """(row_key, features) with the coordinates of every row."""
        rows = _rows(df, row_key, self.numbers, self.categories)
        out = _product(rows, self.levels, self.loadings, self.shift, len(self.categories))
        return out.select(F.col("k").alias(row_key), F.col("y").alias("features"))

    def contributions(self) -> list[tuple[str, int, float]]:
        """(column, component, squared loading x explained variance) summed per source column."""
        k = len(self.explained)
        found = self.levels.groupBy("c").agg(*[F.sum(F.col("v")[j] * F.col("v")[j]).alias(f"s{j}") for j in range(k)])
        out = [(self.categories[r["c"]], j + 1, r[f"s{j}"] * float(self.explained[j]))
               for r in found.collect() for j in range(k)]  # a row per category
        return out + [(f.column, j + 1, float(self.loadings[i, j] ** 2 * self.explained[j]))
                      for i, f in enumerate(self.numbers) for j in range(k)]


def _rows(df: DataFrame, row_key: str, numbers: Sequence[Feature], categories: Sequence[str]) -> DataFrame:
    """(k, x, l0, l1, ...): key, standardised numbers, and the modality of each category as text."""
    fields = {f.name: f for f in df.schema.fields}
    values = []
    for f in numbers:
        value = to_seconds(f.column, fields[f.column].dataType) if is_time(fields[f.column]) else col(f.column).cast("double")
        values.append((value - F.lit(f.centre)) * F.lit(sqrt(f.weight) / f.scale))
    x = F.array(*values) if values else F.array().cast("array<double>")
    return df.select(col(row_key).alias("k"), x.alias("x"), *[
        col(c).cast("string").alias(f"l{i}") for i, c in enumerate(categories)])


def _product(rows: DataFrame, levels: DataFrame, loadings: np.ndarray, shift: Sequence[float], n: int) -> DataFrame:
    """Rows with ``y``: the encoded row times the loadings."""
    width = loadings.shape[1]
    for i in range(n):
        own = levels.where(F.col("c") == i).select(F.col("level").alias(f"l{i}"), F.transform(
            "v", lambda v: v * F.col("factor")).alias(f"v{i}"))
        rows = lookup(rows, own, f"l{i}")
    vectors = [F.col(f"v{i}") for i in range(n)]
    if len(loadings):
        vectors.append(combined(F.col("x"), loadings))
    y = F.zip_with(total(vectors, width), F.array(*[F.lit(float(-s)) for s in shift]), lambda a, b: a + b)
    return rows.withColumn("y", y).drop(*[f"v{i}" for i in range(n)])


def _sums(vector: Column, width: int) -> list[Column]:
    return [F.sum(vector[j]).alias(f"s{j}") for j in range(width)]


def _gram(table: DataFrame, name: str, width: int) -> np.ndarray:
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    row = table.agg(*[F.sum(F.col(name)[i] * F.col(name)[j]).alias(f"g{i}_{j}") for i, j in pairs]).first()
    out = np.zeros((width, width))
    for i, j in pairs:
        out[i, j] = out[j, i] = row[f"g{i}_{j}"] or 0.0
    return out


def fit_sparse_space(
    df: DataFrame, columns: Sequence[str], *, row_key: str, ncp: int = 5,
    weights: Mapping[str, float] | None = None, seed: int = 0, passes: int = PASSES,
) -> SparseSpace:
    """Fit on complete columns. A modality not fitted has no coordinates of its own when rows are placed."""
    weights = dict(weights or {})
    fields = {f.name: f for f in df.schema.fields}
    plain = [c for c in columns if is_number(fields[c]) or is_time(fields[c])]
    categories = tuple(c for c in columns if c not in plain)
    numbers = tuple(f for f in fit_encoder(df, plain, {c: w for c, w in weights.items() if c in plain}).features
                    if f.scale > 0) if plain else ()
    n = df.count()
    place = F.create_map(*[F.lit(x) for i, c in enumerate(categories) for x in (c, i)]) if categories else None
    share = F.col("n") / F.lit(n)
    if categories:
        root = F.create_map(*[F.lit(x) for c in categories for x in (c, sqrt(weights.get(c, 1.0)))])[F.col("column")]
        counted = modality_counts(df, list(categories)).where(F.col("n") < n).select(
            place[F.col("column")].alias("c"), F.col("value").alias("level"),
            (root / F.sqrt(share)).alias("factor"), (root * F.sqrt(share)).alias("pull"))
    else:
        counted = df.sparkSession.createDataFrame([], "c int, level string, factor double, pull double")
    levels = materialize(counted)
    features = len(numbers) + levels.count()
    k = min(ncp, features)
    width = min(k + OVERSAMPLE, features)
    draw = [uniform(seed, f"range{j}", F.col("c"), F.col("level")) - 0.5 for j in range(width)]
    levels = materialize(levels.withColumn("v", F.array(*draw)))
    loadings = np.random.default_rng(seed).uniform(-0.5, 0.5, (len(numbers), width))
    rows = materialize(_rows(df, row_key, numbers, categories))
    zeros = F.array_repeat(F.lit(0.0), width)

    def shift_of(levels: DataFrame) -> list[float]:
        row = levels.agg(*_sums(F.transform("v", lambda v: v * F.col("pull")), width)).first()
        return [row[f"s{j}"] or 0.0 for j in range(width)]

    for turn in range(passes + 1):
        # orthonormal loadings, through the Gram matrix of a few columns
        gram = _gram(levels, "v", width) + loadings.T @ loadings
        size, axes = np.linalg.eigh(gram)
        good = np.where(size > 1e-14 * size.max(initial=1e-300), size, np.inf)
        whiten = axes / np.sqrt(good)
        levels = levels.withColumn("v", combined(F.col("v"), whiten))
        loadings = loadings @ whiten
        levels = materialize(levels)
        moved = materialize(_product(rows, levels, loadings, shift_of(levels), len(categories)))
        if turn == passes:
            break
        if numbers:
            row = moved.agg(*[F.sum(F.col("x")[i] * F.col("y")[j]).alias(f"x{i}_{j}")
                              for i in range(len(numbers)) for j in range(width)]).first()
            loadings = np.array([[row[f"x{i}_{j}"] / n for j in range(width)] for i in range(len(numbers))])
        if categories:
            each = F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"l{i}").alias("level")) for i in range(len(categories))])
            summed = moved.select(F.explode(each).alias("e"), "y").groupBy("e.c", "e.level").agg(*_sums(F.col("y"), width))
            # the mean of y is 0, so centring the indicators changes nothing
            new = summed.select("c", "level", F.array(*[F.col(f"s{j}") / n for j in range(width)]).alias("w"))
            levels = materialize(levels.join(new, ["c", "level"], "left").select(
                "c", "level", "factor", "pull",
                F.transform(F.coalesce("w", zeros), lambda v: v * F.col("factor")).alias("v")))
    values, axes = np.linalg.eigh(_gram(moved, "y", width) / n)
    turned = axes[:, ::-1][:, :k]
    levels = levels.withColumn("v", combined(F.col("v"), turned))
    loadings = loadings @ turned
    # sign: the larger end of each component's loadings is positive
    ends = levels.agg(*[f(F.col("v")[j]).alias(f"{name}{j}") for j in range(k) for name, f in (("a", F.max), ("b", F.min))]).first()
    high = [max([ends[f"a{j}"] or 0.0, *loadings[:, j]]) for j in range(k)]
    low = [min([ends[f"b{j}"] or 0.0, *loadings[:, j]]) for j in range(k)]
    signs = np.array([1.0 if a >= -b else -1.0 for a, b in zip(high, low)])
    levels = materialize(levels.withColumn("v", combined(F.col("v"), np.diag(signs))))
    width = k
    return SparseSpace(numbers, categories, levels, loadings * signs, tuple(shift_of(levels)), values[::-1][:k])
