"""Synthetic rows as random weighted means of nearest neighbours."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskloom.functions.sizing import lookup
from maskloom.functions.uniform import exponential, uniform
from maskloom.functions.validation import INTEGERS, col, is_number, is_time, null_counts
from maskloom.operators.neighbors import nearest
from maskloom.operators.ordinal import hash_ordinal
from maskloom.operators.processors.datetime import from_seconds, to_seconds
from maskloom.operators.synthesis.impute import FLAG, add_missing_flags, impute, restore_missing
from maskloom.operators.synthesis.project import Space, fit_space
from maskloom.session import materialize

TINY = 1e-9
ROW_ORDER, COORDINATE_SIMILARITY = "row_order", "coordinate_similarity"


def neighbor_weights(neighbors: DataFrame, seed: int) -> DataFrame:
    """(query_id, neighbor_id, weight): (1 / distance) x Exp(1) x 2^-rank, rank a random permutation.

    Every group holds the k neighbours of one row.
    """
    drawn = uniform(seed, "generate:rank", "query_id", "neighbor_id")
    shuffle = Window.partitionBy("query_id").orderBy("__u", "neighbor_id")
    ranked = neighbors.withColumn("__u", drawn).withColumn(
        "__rank", F.row_number().over(shuffle)
    )
    spread = exponential(seed, "generate:weight", "query_id", "neighbor_id")
    near = F.lit(1.0) / F.greatest(F.col("distance"), F.lit(TINY))
    weight = near * spread * F.pow(F.lit(2.0), -F.col("__rank").cast("double"))
    return ranked.select("query_id", "neighbor_id", weight.alias("weight"))


def heaviest(votes: Column) -> Column:
    """Value of largest total weight in an array of (weight, value); ties to the smallest value."""
    values = F.array_distinct(F.transform(votes, lambda x: x["v"]))

    def score(value: Column) -> Column:
        same = F.filter(votes, lambda x: x["v"] == value)
        total = F.aggregate(same, F.lit(0.0), lambda acc, x: acc + x["w"])
        return F.struct((-total).alias("s"), value.alias("v"))

    return F.array_min(F.transform(values, score))["v"]


def weighted_rows(
    weights: DataFrame, donors: DataFrame, row_key: str, columns: Sequence[str]
) -> DataFrame:
    """(row_key, columns): weighted mean of numbers and times, heaviest vote of categories.

    One join brings each neighbour's values (copies share neighbours, so it splits hot keys), one
    grouping folds the k rows of each synthetic row.
    """
    fields = {f.name: f for f in donors.schema.fields}
    values, folds, outs = [], [], []
    for i, c in enumerate(columns):
        data_type = fields[c].dataType
        if is_number(fields[c]) or is_time(fields[c]):
            number = to_seconds(c, data_type) if is_time(fields[c]) else col(c).cast("double")
            values.append(number.alias(f"v{i}"))
            folds.append(F.sum(F.col("weight") * F.col(f"v{i}")).alias(f"s{i}"))
            mean = F.col(f"s{i}") / F.col("total")
            outs.append(_back(mean, data_type).alias(c))
        else:
            values.append(col(c).alias(f"v{i}"))
            vote = F.struct(F.col("weight").alias("w"), F.col(f"v{i}").alias("v"))
            folds.append(F.collect_list(vote).alias(f"s{i}"))
            outs.append(heaviest(F.col(f"s{i}")).alias(c))
    table = donors.select(col(row_key).alias("neighbor_id"), *values)
    joined = lookup(weights, table, "neighbor_id", how="inner")
    folded = joined.groupBy("query_id").agg(F.sum("weight").alias("total"), *folds)
    return folded.select(F.col("query_id").alias(row_key), *outs)


def _back(mean: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return from_seconds(mean, data_type)
    if isinstance(data_type, INTEGERS):
        return F.round(mean).cast(data_type)
    return mean.cast(data_type)


@dataclass(frozen=True)
class Synthesis:
    """Row-aligned synthetic rows with everything the metrics reuse."""

    row_key: str
    source: DataFrame
    prepared: DataFrame
    space: Space
    originals: DataFrame
    neighbors: DataFrame
    unshuffled: DataFrame
    columns: tuple[str, ...]
    flagged: tuple[str, ...] = field(default=())
    imputation: Mapping[str, object] = field(default_factory=dict)

    def place(self, synthetic: DataFrame) -> DataFrame:
        """Coordinates of synthetic rows in the space of the originals."""
        return self.space.place(complete(synthetic, self), self.row_key)


def complete(df: DataFrame, synthesis: Synthesis) -> DataFrame:
    """Flags and temporary imputation, as done for the originals: by the same method, statistics and donors."""
    if not synthesis.flagged:
        return df
    return impute(
        add_missing_flags(df, synthesis.flagged), synthesis.columns, row_key=synthesis.row_key,
        reference=add_missing_flags(synthesis.source, synthesis.flagged), **synthesis.imputation)


def synthesize(
    df: DataFrame,
    row_key: str,
    *,
    k: int,
    ncp: int | None = 5,
    columns: Sequence[str] | None = None,
    column_weights: Mapping[str, float] | None = None,
    use_categorical_reduction: bool = False,
    imputation_method: str = "fast_knn",
    imputation_k: int = 5,
    imputation_training_fraction: float = 1.0,
    seed: int = 0,
) -> Synthesis:
    """Synthetic twin of every row of ``df``, with the columns and types of the source.

    The prepared table, its coordinates, the neighbours and the result are each written once, since
    several later stages read them.
    """
    used = [c for c in (columns or df.columns) if c != row_key]
    source = df.select(col(row_key), *map(col, used))
    counts = null_counts(source, [row_key, *used])
    if counts[row_key]:
        raise ValueError("Expected no missing values for the row key")
    flagged = tuple(c for c in used if counts[c])
    prepared = source
    imputation = {"method": imputation_method, "k": imputation_k, "training_fraction": imputation_training_fraction,
                  "seed": seed, "distance_columns": used}
    if flagged:
        prepared = impute(add_missing_flags(source, flagged), used, row_key=row_key, **imputation)
        prepared = materialize(prepared)
    encoded = used + [c + FLAG for c in flagged]
    space = fit_space(
        prepared, encoded, row_key=row_key, ncp=ncp, weights=column_weights,
        use_categorical_reduction=use_categorical_reduction,
    )
    originals = materialize(space.place(prepared, row_key))
    neighbors = nearest(
        originals, originals, k, query_key=row_key, candidate_key=row_key, exclude_self=True
    )
    neighbors = materialize(neighbors)
    weights = neighbor_weights(neighbors, seed)
    rows = weighted_rows(weights, prepared, row_key, encoded)
    if flagged:
        rows = restore_missing(rows, flagged)
    unshuffled = materialize(rows.select(col(row_key), *map(col, used)))
    return Synthesis(
        row_key, source, prepared, space, originals, neighbors, unshuffled, tuple(used), flagged,
        imputation,
    )


def shuffle_rows(unshuffled: DataFrame, row_key: str, *, seed: int = 0) -> DataFrame:
    """Publishable rows: random order, a new key, no trace of the old one."""
    placed = hash_ordinal(unshuffled, row_key, seed=seed, stream="publish", output="__new")
    others = [c for c in unshuffled.columns if c != row_key]
    return placed.select(F.col("__new").alias(row_key), *map(col, others))


def attach_excluded(
    synthesis: Synthesis,
    original: DataFrame,
    excluded: Sequence[str],
    *,
    strategy: str = ROW_ORDER,
) -> DataFrame:
    """Put back variables kept out of the synthesis.

    ``row_order`` copies them from the own source row, ``coordinate_similarity`` from the original
    nearest to the synthetic row.
    """
    key = synthesis.row_key
    extra = original.select(col(key).alias("__donor"), *map(col, excluded))
    rows = synthesis.unshuffled
    if strategy == ROW_ORDER:
        return rows.join(extra, col(key) == F.col("__donor"), "left").drop("__donor")
    if strategy != COORDINATE_SIMILARITY:
        raise ValueError(
            f"Expected {ROW_ORDER!r} or {COORDINATE_SIMILARITY!r}, got {strategy!r} instead"
        )
    near = materialize(nearest(
        synthesis.place(rows), synthesis.originals, 1, query_key=key, candidate_key=key
    ).select(F.col("query_id").alias("__q"), F.col("neighbor_id").alias("__donor")))
    matched = rows.join(near, col(key) == F.col("__q"), "left")
    return lookup(matched, extra, "__donor").select(
        *map(col, rows.columns), *map(col, excluded)
    )
