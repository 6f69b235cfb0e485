"""Equal-width bins with a closed last bin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom.functions.validation import col


def bin_edge(index: Column, low: Column, high: Column, bins: int) -> Column:
    """Edge ``index`` of ``bins`` bins over [low, high]; the last edge is exactly ``high``."""
    step = (high - low) / F.lit(float(bins))
    return F.when(index >= bins, high).otherwise(index * step + low)


def bin_index(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Bin of ``value``, corrected where the division lands on the wrong side of an edge."""
    raw = F.floor((value - low) / (high - low) * F.lit(float(bins))).cast("int")
    raw = F.greatest(F.least(raw, F.lit(bins - 1)), F.lit(0))
    shift = (
        F.when((value < bin_edge(raw, low, high, bins)) & (raw > 0), -1)
        .when((value >= bin_edge(raw + 1, low, high, bins)) & (raw < bins - 1), 1)
        .otherwise(0)
    )
    return raw + shift


def value_range(df: DataFrame, column: str) -> tuple[float, float]:
    """(low, high) with a constant column widened by half on both sides."""
    row = df.agg(
        F.min(col(column)).cast("double").alias("lo"), F.max(col(column)).cast("double").alias("hi")
    ).first()
    if row["lo"] is None:
        raise ValueError(f"column {column} holds no value")
    return (row["lo"] - 0.5, row["hi"] + 0.5) if row["lo"] == row["hi"] else (row["lo"], row["hi"])


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """(bin, lower, upper, n) of the non-empty bins."""
    lo, hi = value_range(df, column)
    low, high = F.lit(lo), F.lit(hi)
    index = bin_index(col(column).cast("double"), low, high, bins)
    counted = df.where(col(column).isNotNull()).groupBy(index.alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    lower = bin_edge(F.col("bin"), low, high, bins)
    upper = bin_edge(F.col("bin") + 1, low, high, bins)
    return counted.select("bin", lower.alias("lower"), upper.alias("upper"), "n")


def histogram_2d(df: DataFrame, x: str, y: str, bins: int) -> DataFrame:
    """(x_bin, y_bin, n) of the non-empty cells."""
    (xl, xh), (yl, yh) = value_range(df, x), value_range(df, y)
    x_bin = bin_index(col(x).cast("double"), F.lit(xl), F.lit(xh), bins)
    y_bin = bin_index(col(y).cast("double"), F.lit(yl), F.lit(yh), bins)
    present = df.where(col(x).isNotNull() & col(y).isNotNull())
    return present.groupBy(x_bin.alias("x_bin"), y_bin.alias("y_bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
