"""Rare modalities grouped under one name."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.functions.sizing import lookup
from maskloom.functions.validation import col
from maskloom.operators.processors import messages as msg
from maskloom.operators.profile import categorical_columns, distinct_counts, modality_counts
from maskloom.session import materialize


@dataclass(frozen=True)
class GroupModalitiesModel:
    """``rare`` is a (column, value) table of the modalities to rename."""

    thresholds: Mapping[str, int]
    rare: DataFrame | None
    new_category: str

    def preprocess(self, df: DataFrame) -> DataFrame:
        out = df
        for c in self.thresholds:
            names = self.rare.where(F.col("column") == F.lit(c)).select(
                F.col("value").alias("__value"), F.lit(True).alias("__rare")
            )
            out = lookup(out.withColumn("__value", col(c).cast("string")), names, "__value")
            renamed = F.when(F.col("__rare").isNotNull(), F.lit(self.new_category)).otherwise(
                col(c).cast("string")
            )
            out = out.withColumn(c, renamed).select(*map(col, df.columns))
        return out

    def postprocess(self, source: DataFrame, dest: DataFrame) -> DataFrame:
        """Identity: grouping cannot be undone."""
        return dest


@dataclass(frozen=True)
class GroupModalitiesProcessor:
    """Modalities with at most ``threshold`` rows become ``new_category``; nulls stay.

    Either ``variable_thresholds`` per column, or ``min_unique`` and ``global_threshold`` for every
    categorical column with at least ``min_unique`` modalities.
    """

    variable_thresholds: Mapping[str, int] | None = None
    min_unique: int | None = None
    global_threshold: int | None = None
    new_category: str = "other"

    def __post_init__(self) -> None:
        generic = (self.global_threshold, self.min_unique)
        if bool(self.global_threshold) != bool(self.min_unique):
            raise ValueError(msg.GENERIC_INCOMPLETE.format(value=generic))
        if bool(self.variable_thresholds) == bool(self.global_threshold):
            raise ValueError(
                msg.THRESHOLDS_CHOICE.format(mapping=self.variable_thresholds, generic=generic)
            )

    def fit(self, df: DataFrame) -> GroupModalitiesModel:
        if self.variable_thresholds:
            thresholds = dict(self.variable_thresholds)
            unknown = [c for c in thresholds if c not in df.columns]
            if unknown:
                raise ValueError(msg.THRESHOLDS_INVALID, f"got {unknown} instead.")
        else:
            counts = {
                r["column"]: r["n_unique"]
                for r in distinct_counts(df, categorical_columns(df)).collect()
            }
            thresholds = {
                c: self.global_threshold for c in df.columns if counts.get(c, 0) >= self.min_unique
            }
        if not thresholds:
            return GroupModalitiesModel({}, None, self.new_category)
        limit = F.create_map(*[F.lit(v) for pair in thresholds.items() for v in pair])
        counts = modality_counts(df, list(thresholds))
        rare = counts.where(F.col("n") <= limit[F.col("column")]).select("column", "value")
        # read once per column and once per size check
        rare = materialize(rare)
        return GroupModalitiesModel(thresholds, rare, self.new_category)
