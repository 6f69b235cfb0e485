"""Projection of encoded rows on their main components."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.functions.validation import col, is_number, is_time
from maskloom.operators.profile import modality_counts
from maskloom.operators.synthesis.encode import MAX_LEVELS, Encoder, Feature, fit_encoder
from maskloom.operators.synthesis.sparse import SparseSpace, fit_sparse_space

REDUCED_DIMS = 20


@dataclass(frozen=True)
class Components:
    """PCA with a fixed sign: in every component the loading of largest size is positive."""

    model: PCAModel
    signs: tuple[float, ...]

    @property
    def loadings(self) -> np.ndarray:
        return self.model.pc.toArray() * np.array(self.signs)[None, :]

    @property
    def explained(self) -> np.ndarray:
        return self.model.explainedVariance.toArray()

    def transform(self, df: DataFrame, column: str) -> DataFrame:
        vector = df.withColumn("__vec", array_to_vector(col(column)))
        scores = self.model.transform(vector)
        signs = F.array(*[F.lit(s) for s in self.signs])
        out = F.zip_with(vector_to_array("__pca"), signs, lambda x, s: x * s)
        return scores.withColumn(column, out).drop("__vec", "__pca")


def fit_components(df: DataFrame, column: str, dims: int) -> Components:
    """The Gram matrix is summed on the executors; only features x features numbers reach the driver."""
    vectors = df.select(array_to_vector(col(column)).alias("__vec"))
    model = PCA(k=dims, inputCol="__vec", outputCol="__pca").fit(vectors)
    loadings = model.pc.toArray()
    top = np.abs(loadings).argmax(axis=0)
    signs = tuple(1.0 if loadings[t, j] >= 0 else -1.0 for j, t in enumerate(top))
    return Components(model, signs)


@dataclass(frozen=True)
class Space:
    """Where distances are measured: encoder, optional category reduction, optional projection."""

    encoder: Encoder
    numbers: tuple[Feature, ...]
    indicators: tuple[Feature, ...]
    reduction: Components | None
    projection: Components | None

    def _features(self, df: DataFrame, row_key: str) -> DataFrame:
        if self.reduction is None:
            return self.encoder.encode(df, row_key)
        plain = self.encoder.expressions(df, self.numbers)
        block = self.encoder.expressions(df, self.indicators)
        parts = df.select(col(row_key), plain.alias("__plain"), block.alias("__block"))
        reduced = self.reduction.transform(parts, "__block")
        return reduced.select(col(row_key), F.concat("__plain", "__block").alias("features"))

    def place(self, df: DataFrame, row_key: str) -> DataFrame:
        """(row_key, features) with the coordinates of every row."""
        features = self._features(df, row_key)
        if self.projection is None:
            return features
        return self.projection.transform(features, "features")

    def contributions(self) -> list[tuple[str, int, float]]:
        """(column, component, squared loading x explained variance) summed per source column."""
        if self.projection is None or self.reduction is not None:
            raise ValueError("Expected a projected space without categorical reduction")
        loadings, explained = self.projection.loadings, self.projection.explained
        out: dict[tuple[str, int], float] = {}
        for i, feature in enumerate(self.encoder.features):
            for j in range(loadings.shape[1]):
                key = (feature.column, j + 1)
                out[key] = out.get(key, 0.0) + float(loadings[i, j] ** 2 * explained[j])
        return [(c, j, v) for (c, j), v in out.items()]


def fit_space(
    df: DataFrame,
    columns: Sequence[str],
    *,
    row_key: str,
    ncp: int | None = 5,
    weights: Mapping[str, float] | None = None,
    use_categorical_reduction: bool = False,
) -> Space | SparseSpace:
    """Fit on complete columns. ``ncp=None`` keeps the encoded features as coordinates.

    With more than ``MAX_LEVELS`` modalities the encoded row is too wide to be written out, and the space is
    a ``SparseSpace`` (the same components, found without it).
    """
    fields = {f.name: f for f in df.schema.fields}
    categories = [c for c in columns if not (is_number(fields[c]) or is_time(fields[c]))]
    if categories and modality_counts(df, categories).limit(MAX_LEVELS + 1).count() > MAX_LEVELS:
        if ncp is None:
            raise ValueError("Expected a number of components with so many modalities")
        return fit_sparse_space(df, columns, row_key=row_key, ncp=ncp, weights=weights)
    encoder = fit_encoder(df, columns, weights)
    numbers = tuple(f for f in encoder.features if f.level is None)
    indicators = tuple(f for f in encoder.features if f.level is not None)
    assert all(is_number(fields[f.column]) or is_time(fields[f.column]) for f in numbers)
    reduction = None
    if use_categorical_reduction and len(indicators) > 1:
        block = df.select(encoder.expressions(df, indicators).alias("__block"))
        reduction = fit_components(block, "__block", min(REDUCED_DIMS, len(indicators)))
    space = Space(encoder, numbers, indicators, reduction, None)
    if ncp is None:
        return space
    width = len(numbers) + (len(reduction.signs) if reduction else len(indicators))
    features = space._features(df, row_key)
    projection = fit_components(features, "features", min(ncp, width))
    return Space(encoder, numbers, indicators, reduction, projection)
