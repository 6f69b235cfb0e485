"""Utility metrics and the tables behind the usual plots."""

from __future__ import annotations

from collections.abc import Sequence


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom.functions.validation import col, is_number, is_time
from maskloom.operators.comoments import correlation, pair_moments
from maskloom.operators.histogram import bin_index
from maskloom.operators.processors.datetime import to_seconds
from maskloom.operators.synthesis.project import Space

BINS = 20
CORRELATION_TOLERANCE = 0.1


def _number(df: DataFrame, name: str) -> Column:
    field = df.schema[name]
    return to_seconds(name, field.dataType) if is_time(field) else col(name).cast("double")


def _numeric(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if is_number(df.schema[c]) or is_time(df.schema[c])]


def distributions(
    original: DataFrame, synthetic: DataFrame, columns: Sequence[str], bins: int = BINS
) -> DataFrame:
    """(column, bin, original, synthetic): shares per column.

    Numbers fall in equal bins over the joint range (bin number as text), categories keep their
    value, nulls form a bin of their own (NULL). Counts are combined before the only shuffle.
    """
    numbers = _numeric(original, columns)
    limits = {}
    if numbers:
        low = [F.min(_number(original, c)).alias(f"lo{i}") for i, c in enumerate(numbers)]
        high = [F.max(_number(original, c)).alias(f"hi{i}") for i, c in enumerate(numbers)]
        a = original.agg(*low, *high).first()
        low = [F.min(_number(synthetic, c)).alias(f"lo{i}") for i, c in enumerate(numbers)]
        high = [F.max(_number(synthetic, c)).alias(f"hi{i}") for i, c in enumerate(numbers)]
        b = synthetic.agg(*low, *high).first()
        for i, c in enumerate(numbers):
            lo = min((x for x in (a[f"lo{i}"], b[f"lo{i}"]) if x is not None), default=0.0)
            hi = max((x for x in (a[f"hi{i}"], b[f"hi{i}"]) if x is not None), default=0.0)
            limits[c] = (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)

    def binned(df: DataFrame, side: str) -> DataFrame:
        cells = []
        for c in columns:
            if c in limits:
                lo, hi = limits[c]
                label = bin_index(_number(df, c), F.lit(lo), F.lit(hi), bins).cast("string")
            else:
                label = col(c).cast("string")
            cells.append(F.struct(F.lit(c).alias("column"), label.alias("bin")))
        one = {s: F.lit(1 if s == side else 0) for s in ("original", "synthetic")}
        return df.select(F.explode(F.array(*cells)).alias("x")).select(
            "x.column", "x.bin", *[v.alias(s) for s, v in one.items()]
        )

    both = binned(original, "original").unionAll(binned(synthetic, "synthetic"))
    counts = both.groupBy("column", "bin").agg(
        F.sum("original").alias("o"), F.sum("synthetic").alias("s")
    )
    # every column counts every row once, so the totals are the row counts
    n, m = original.count(), synthetic.count()
    return counts.select(
        "column", "bin", (F.col("o") / n).alias("original"), (F.col("s") / m).alias("synthetic")
    )


def hellinger_columns(
    original: DataFrame, synthetic: DataFrame, columns: Sequence[str], bins: int = BINS
) -> DataFrame:
    """(column, hellinger): sqrt(1 - sum sqrt(p q))."""
    shares = distributions(original, synthetic, columns, bins)
    overlap = F.sum(F.sqrt(F.col("original") * F.col("synthetic")))
    distance = F.sqrt(F.greatest(1 - overlap, F.lit(0.0)))
    return shares.groupBy("column").agg(distance.alias("hellinger"))


def hellinger(
    original: DataFrame, synthetic: DataFrame, columns: Sequence[str]
) -> dict[str, float]:
    row = hellinger_columns(original, synthetic, columns).agg(
        F.avg("hellinger").alias("mean"), F.stddev_samp("hellinger").alias("std")
    ).first()
    return {"hellinger_mean": row["mean"], "hellinger_std": row["std"]}


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, rho) for all pairs of columns, from one pass of mergeable sums.

    Pairwise complete rows; NULL for a constant column.
    """
    names = _numeric(df, columns)
    if not names:
        return df.sparkSession.createDataFrame([], "a string, b string, rho double")
    found = pair_moments(df, [_number(df, c) for c in names]).select("i", "j", correlation().alias("rho"))
    listed = F.array(*[F.lit(c) for c in names])
    ways = F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(
        F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))))
    return found.select(F.explode(ways).alias("x"), "rho").select(
        listed[F.col("x.i")].alias("a"), listed[F.col("x.j")].alias("b"), "rho")


def correlation_difference(
    original: DataFrame, synthetic: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """(a, b, difference): rho of the originals less rho of the synthetic rows."""
    left = correlations(original, columns)
    right = correlations(synthetic, columns).withColumnRenamed("rho", "__rho")
    joined = left.join(right, ["a", "b"], "inner")
    return joined.select("a", "b", (F.col("rho") - F.col("__rho")).alias("difference"))


def correlation_difference_ratio(
    original: DataFrame, synthetic: DataFrame, columns: Sequence[str]
) -> float | None:
    """100 x share of numeric pairs whose correlation moved by more than 0.1."""
    pairs = correlation_difference(original, synthetic, columns).where("a < b")
    moved = (F.abs("difference") > F.lit(CORRELATION_TOLERANCE)).cast("double")
    return pairs.agg((F.avg(moved) * 100).alias("v")).first()["v"]


def aggregate_stats(original: DataFrame, synthetic: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, side, mean, std) of the numeric ones among the first ten columns."""
    names = [c for c in _numeric(original, columns[:10])]

    def stats(df: DataFrame, side: str) -> DataFrame:
        aggs, cells = [], []
        for i, c in enumerate(names):
            aggs += [F.avg(_number(df, c)).alias(f"m{i}"),
                     F.stddev_samp(_number(df, c)).alias(f"s{i}")]
            cells.append(F.struct(
                F.lit(c).alias("column"), F.lit(side).alias("side"),
                F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"),
            ))
        return df.agg(*aggs).select(F.explode(F.array(*cells)).alias("x")).select("x.*")

    return stats(original, "original").unionByName(stats(synthetic, "synthetic"))


def projection_points(originals: DataFrame, synthetic: DataFrame, key: str, dims: int) -> DataFrame:
    """(key, side, x1..xdims): first coordinates of both tables."""
    axes = [F.col("features")[d].alias(f"x{d + 1}") for d in range(dims)]
    left = originals.select(col(key), F.lit("original").alias("side"), *axes)
    return left.unionByName(synthetic.select(col(key), F.lit("synthetic").alias("side"), *axes))


def contributions(df: DataFrame, space: Space) -> DataFrame:
    """(column, component, contribution) of the fitted projection; model-sized."""
    return df.sparkSession.createDataFrame(
        space.contributions(), "column string, component int, contribution double"
    )
