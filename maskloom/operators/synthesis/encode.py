"""Mixed columns as one numeric vector: standardised numbers and scaled indicators.

A number becomes (x - mean) / std; a category becomes one indicator per modality, (z - p) / sqrt(p),
the usual scaling of factor analysis of mixed data. Features of a column are multiplied by the
square root of the column's weight.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom.functions.validation import col, is_number, is_time
from maskloom.operators.processors.datetime import seconds_sql, to_seconds
from maskloom.operators.profile import modality_counts

MAX_LEVELS = 2_000


@dataclass(frozen=True)
class Feature:
    """One number per row; ``level`` is set for the indicator of a modality."""

    column: str
    level: str | None
    centre: float
    scale: float
    weight: float


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Encoder:
    """Fitted features; a few numbers per column and modality, at most ``MAX_LEVELS`` of these."""

    features: tuple[Feature, ...]

    @property
    def columns(self) -> list[str]:
        return list(dict.fromkeys(f.column for f in self.features))

    def expressions(self, df: DataFrame, features: Sequence[Feature] | None = None) -> Column:
        """Array of the feature values.

        Written as one SQL text: a feature per modality would otherwise cost the driver several
        calls into the JVM each.
        """
        fields = {f.name: f for f in df.schema.fields}
        out = []
        for feature in self.features if features is None else features:
            if feature.scale == 0.0:
                out.append("0.0D")
                continue
            name = "`" + feature.column.replace("`", "``") + "`"
            if feature.level is not None:
                value = f"if(cast({name} as string) = {_quoted(feature.level)}, 1.0D, 0.0D)"
            elif is_time(fields[feature.column]):
                value = seconds_sql(feature.column, fields[feature.column].dataType)
            else:
                value = f"cast({name} as double)"
            factor = sqrt(feature.weight) / feature.scale
            out.append(f"({value} - ({feature.centre!r}D)) * {factor!r}D")
        return F.expr(f"cast(array({', '.join(out)}) as array<double>)")

    def encode(self, df: DataFrame, row_key: str, output: str = "features") -> DataFrame:
        """(row_key, features): only the encoded columns are read."""
        return df.select(col(row_key), self.expressions(df).alias(output))


def fit_encoder(
    df: DataFrame, columns: Sequence[str], weights: Mapping[str, float] | None = None
) -> Encoder:
    """Means, deviations and modality shares in two aggregate passes."""
    weights = dict(weights or {})
    unknown = set(weights) - set(df.columns)
    if unknown:
        raise ValueError(f"Expected column weights for columns of the table, got {unknown} instead")
    fields = {f.name: f for f in df.schema.fields}
    numbers = [c for c in columns if is_number(fields[c]) or is_time(fields[c])]
    categories = [c for c in columns if c not in numbers]
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(numbers):
        value = to_seconds(c, fields[c].dataType) if is_time(fields[c]) else col(c).cast("double")
        aggs += [F.avg(value).alias(f"m{i}"), F.stddev_pop(value).alias(f"s{i}")]
    row = df.agg(*aggs).first()
    number_features = {
        c: [Feature(c, None, row[f"m{i}"] or 0.0, row[f"s{i}"] or 0.0, float(weights.get(c, 1.0)))]
        for i, c in enumerate(numbers)
    }
    levels: dict[str, list[Feature]] = {c: [] for c in categories}
    if categories:
        found = modality_counts(df, categories).limit(MAX_LEVELS + 1).collect()
        if len(found) > MAX_LEVELS:
            raise ValueError(
                f"Expected at most {MAX_LEVELS} modalities in {categories}; "
                "group rare modalities first"
            )
        for r in sorted(found, key=lambda r: (r["column"], r["value"])):
            share = r["n"] / row["n"]
            constant = share >= 1.0
            levels[r["column"]].append(Feature(
                r["column"], r["value"], share, 0.0 if constant else sqrt(share),
                float(weights.get(r["column"], 1.0)),
            ))
    ordered = [f for c in columns for f in (number_features.get(c) or levels.get(c, []))]
    return Encoder(tuple(ordered))
