"""Missing values: flags that join the synthesis, and temporary imputation."""

from __future__ import annotations

from collections.abc import Sequence
from math import isfinite

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.functions.sizing import lookup
from maskloom.functions.uniform import uniform
from maskloom.functions.validation import col, is_number, null_counts
from maskloom.operators.neighbors import nearest
from maskloom.operators.quantiles import exact_quantiles
from maskloom.session import materialize

MEAN, MEDIAN, MODE, KNN, FAST_KNN = "mean", "median", "mode", "knn", "fast_knn"
METHODS = (MEAN, MEDIAN, MODE, KNN, FAST_KNN)
FLAG = "__isna"


def add_missing_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``<column>__isna`` 0/1 next to each of ``columns``."""
    return df.withColumns({c + FLAG: col(c).isNull().cast("int") for c in columns})


def restore_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL where the flag is 1; flags dropped."""
    restored = {c: F.when(col(c + FLAG) == 1, F.lit(None)).otherwise(col(c)) for c in columns}
    return df.withColumns(restored).drop(*[c + FLAG for c in columns])


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Most frequent value per column, ties to the smallest value."""
    out = {}
    for c in columns:
        counts = df.where(col(c).isNotNull()).groupBy(col(c).alias("v")).count()
        row = counts.agg(F.min(F.struct((-F.col("count")).alias("n"), F.col("v"))).alias("m")).first()
        out[c] = row["m"]["v"] if row["m"] else None
    return out


def impute(
    df: DataFrame,
    columns: Sequence[str],
    *,
    method: str = FAST_KNN,
    row_key: str,
    k: int = 5,
    training_fraction: float = 1.0,
    seed: int = 0,
    distance_columns: Sequence[str] | None = None,
    reference: DataFrame | None = None,
) -> DataFrame:
    """Fill nulls of ``columns``. Categorical columns always take the mode, or the vote of
    the neighbours under the k-NN methods.

    Statistics and neighbours are those of ``reference`` where given (a table with the same columns), so two
    tables can be filled alike; by default those of ``df``.
    """
    fitted = df if reference is None else reference
    if method not in METHODS:
        raise ValueError(f"Expected an imputation method among {METHODS}, got {method!r} instead")
    counts = null_counts(df, columns)
    missing = [c for c in columns if counts[c]]
    if not missing:
        return df
    numbers = {f.name for f in df.schema.fields if is_number(f)}
    if method in (KNN, FAST_KNN):
        fraction = training_fraction if method == FAST_KNN else 1.0
        return _impute_knn(df, fitted, missing, numbers, row_key, k, fraction, seed, distance_columns)
    fill: dict[str, object] = {}
    if method == MODE:
        fill = modes(fitted, missing)
    else:
        numeric = [c for c in missing if c in numbers]
        if method == MEAN and numeric:
            fill = fitted.agg(*[F.avg(col(c)).alias(c) for c in numeric]).first().asDict()
        for c in numeric if method == MEDIAN else []:
            fill[c] = exact_quantiles(fitted, c, [0.5])[0]
        fill |= modes(fitted, [c for c in missing if c not in numbers])
    types = {f.name: f.dataType for f in df.schema.fields}
    out = {}
    for c in missing:
        value = F.lit(fill[c])
        if c in numbers and types[c].typeName() in ("integer", "long", "short", "byte"):
            value = F.round(value)
        out[c] = F.coalesce(col(c), value.cast(types[c]))
    return df.withColumns(out)


def _impute_knn(df, fitted, missing, numbers, row_key, k, fraction, seed, distance_columns) -> DataFrame:
    """Mean (or vote) over the k nearest complete rows, by the standardised observed numbers.

    One search for all rows, whatever they lack: a null is not measured. Without a ``reference`` a row that
    has no number at all is an error; with one it takes the donors of the smallest keys.
    """
    axes = [c for c in (distance_columns or df.columns) if c in numbers and c != row_key]
    stats = fitted.agg(*[F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(axes)],
                   *[F.stddev_pop(col(c)).alias(f"s{i}") for i, c in enumerate(axes)]).first()
    z = {
        c: (col(c).cast("double") - F.lit(stats[f"m{i}"])) / F.lit(stats[f"s{i}"])
        for i, c in enumerate(axes) if stats[f"s{i}"] and isfinite(stats[f"s{i}"])
    }
    whole, gap = F.lit(True), F.lit(False)
    for c in sorted(set(missing) | set(z)):
        whole = whole & col(c).isNotNull()
    for c in missing:
        gap = gap | col(c).isNull()
    measured = F.array(*z.values()) if z else F.array().cast("array<double>")
    asked = df.where(gap).select(col(row_key).alias("__qid"), measured.alias("features"))
    if df is fitted and (not z or asked.where(~F.exists("features", lambda x: x.isNotNull())).take(1)):
        raise ValueError("a row with gaps has no observed number to measure distances")
    training = fitted.where(whole)
    if fraction < 1.0:
        training = training.where(uniform(seed, "impute", col(row_key)) < F.lit(float(fraction)))
    donors = materialize(training.select(
        col(row_key).alias("neighbor_id"), measured.alias("features"), *[col(c).alias(f"__d_{c}") for c in missing]))
    near = materialize(nearest(asked, donors, k, query_key="__qid", candidate_key="neighbor_id"))
    aggs = []
    for c in missing:
        given = col(f"__d_{c}")
        aggs.append((F.avg(given) if c in numbers else most_frequent(F.collect_list(given))).alias(f"__f_{c}"))
    picked = lookup(near, donors.drop("features"), "neighbor_id", how="inner")
    filled = picked.groupBy(F.col("query_id").alias("__qid")).agg(*aggs)
    types = {f.name: f.dataType for f in df.schema.fields}
    out = {}
    for c in missing:
        value = F.col(f"__f_{c}")
        if types[c].typeName() in ("integer", "long", "short", "byte"):
            value = F.round(value)
        out[c] = F.coalesce(col(c), value.cast(types[c]))
    joined = df.join(filled, col(row_key) == F.col("__qid"), "left")
    return joined.withColumns(out).select(*map(col, df.columns))


def most_frequent(values):
    """Most frequent element of a short array, ties to the smallest."""
    scored = F.transform(
        F.array_distinct(values),
        lambda v: F.struct((-F.size(F.filter(values, lambda x: x == v))).alias("n"), v.alias("v")),
    )
    return F.array_min(scored)["v"]
