"""Columns as proportions of a reference, and targets as differences to references."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom.functions.rounding import saferound_columns
from maskloom.functions.validation import col, has_nulls
from maskloom.operators.processors import messages as msg


def null_skipping_sum(columns: Sequence[str]) -> Column:
    total = F.lit(0.0)
    for c in columns:
        total = total + F.coalesce(col(c).cast("double"), F.lit(0.0))
    return total


@dataclass(frozen=True)
class ProportionProcessor:
    """Row-local: ``v / sum(v)`` (or ``v / reference``), zeros kept at zero, nulls kept.

    A division by zero gives NULL.
    """

    variable_names: Sequence[str]
    reference: str
    sum_to_one: bool = True
    decimal_count: int = 1

    def fit(self, df: DataFrame) -> ProportionProcessor:
        return self

    def _check(self, df: DataFrame) -> None:
        if self.reference not in df.columns:
            raise ValueError("variable_name", msg.REFERENCE_NOT_FOUND.format(name=self.reference))

    def preprocess(self, df: DataFrame) -> DataFrame:
        self._check(df)
        whole = (
            null_skipping_sum(self.variable_names)
            if self.sum_to_one
            else col(self.reference).cast("double")
        )
        share = {
            c: F.when(col(c) == 0, F.lit(0.0)).otherwise(F.try_divide(col(c).cast("double"), whole))
            for c in self.variable_names
        }
        return df.withColumns(share)

    def postprocess(self, source: DataFrame, dest: DataFrame) -> DataFrame:
        self._check(dest)
        reference = col(self.reference).cast("double")
        scaled = {c: col(c).cast("double") * reference for c in self.variable_names}
        if not self.sum_to_one:
            return dest.withColumns(scaled)
        whole = null_skipping_sum(self.variable_names)
        amounts = {c: F.try_divide(v, whole) for c, v in scaled.items()}
        return saferound_columns(
            dest.withColumns(amounts), list(self.variable_names), self.decimal_count
        )


@dataclass(frozen=True)
class RelativeDifferenceProcessor:
    """Row-local: ``(target - sum(references)) / scaling_unit``."""

    target: str
    references: Sequence[str]
    scaling_unit: int | None = None
    target_rename: str | None = None
    drop_original_target: bool = False

    def __post_init__(self) -> None:
        if self.drop_original_target and self.target_rename is None:
            raise ValueError(msg.DROP_WITHOUT_RENAME.format(value=self.drop_original_target))

    @property
    def renamed(self) -> str:
        return self.target_rename or self.target

    def fit(self, df: DataFrame) -> RelativeDifferenceProcessor:
        return self

    def _check(self, df: DataFrame) -> None:
        wrong = set(self.references) - set(df.columns)
        if wrong:
            raise ValueError(msg.REFERENCES_INVALID.format(names=wrong))

    def preprocess(self, df: DataFrame) -> DataFrame:
        self._check(df)
        if has_nulls(df, list(self.references)):
            raise ValueError(msg.REFERENCES_NULLS)
        gap = col(self.target).cast("double") - null_skipping_sum(self.references)
        out = df.withColumn(self.renamed, gap / F.lit(float(self.scaling_unit or 1)))
        return out.drop(self.target) if self.drop_original_target else out

    def postprocess(self, source: DataFrame, dest: DataFrame) -> DataFrame:
        self._check(dest)
        gap = col(self.renamed).cast("double") * F.lit(float(self.scaling_unit or 1))
        return dest.withColumn(self.target, gap + null_skipping_sum(self.references))
