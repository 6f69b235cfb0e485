"""Low-cardinality numeric columns handled as categories."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.functions.validation import col
from maskloom.operators.profile import numeric_under_threshold


@dataclass(frozen=True)
class ToCategoricalModel:
    variables: tuple[str, ...]
    keep_continuous: bool
    continuous_suffix: str
    category: str

    def preprocess(self, df: DataFrame) -> DataFrame:
        columns = {}
        if self.keep_continuous:
            columns |= {c + self.continuous_suffix: col(c) for c in self.variables}
        columns |= {c: col(c).cast("string") for c in self.variables}
        return df.withColumns(columns) if columns else df

    def postprocess(self, source: DataFrame, dest: DataFrame) -> DataFrame:
        types = {f.name: f.dataType for f in source.schema.fields}
        columns = {}
        for c in self.variables:
            # try_cast: the grouped category is no number and plain casts raise under ANSI
            back = col(c).cast("string").try_cast(types[c])
            if self.keep_continuous:
                copy = col(c + self.continuous_suffix).cast(types[c])
                back = F.when(col(c) == F.lit(self.category), copy).otherwise(back)
            columns[c] = back
        out = dest.withColumns(columns) if columns else dest
        if self.keep_continuous:
            out = out.drop(*[c + self.continuous_suffix for c in self.variables])
        return out


@dataclass(frozen=True)
class ToCategoricalProcessor:
    """Numeric columns with at most ``to_categorical_threshold`` values become strings."""

    to_categorical_threshold: int
    keep_continuous: bool = False
    continuous_suffix: str = "__cont"
    category: str = "other"

    def fit(self, df: DataFrame) -> ToCategoricalModel:
        chosen = numeric_under_threshold(df, threshold=self.to_categorical_threshold)
        return ToCategoricalModel(
            tuple(chosen), self.keep_continuous, self.continuous_suffix, self.category
        )
