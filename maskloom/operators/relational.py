"""Small table operators used around processors and synthesis."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, exp

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.functions.uniform import uniform
from maskloom.functions.validation import col, key_difference
from maskloom.operators.scan import MAX_GROUP_ROWS, scan


def value_counts(df: DataFrame, column: str, output: str = "n") -> DataFrame:
    present = df.where(col(column).isNotNull())
    return present.groupBy(col(column)).agg(F.count(F.lit(1)).alias(output))


def value_count_difference(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """(column, difference): counts of ``left`` less counts of ``right``; NULL if on one side only."""
    a = value_counts(left, column, "__a")
    b = value_counts(right, column, "__b")
    return a.join(b, column, "full_outer").select(
        col(column), (F.col("__a") - F.col("__b")).alias("difference")
    )


def order_by_categories(df: DataFrame, column: str, categories: Sequence[str], *then: str):
    """Sort by a user-given category order; unknown categories go last."""
    place = F.array_position(F.array(*[F.lit(c) for c in categories]), col(column))
    place = F.when(place > 0, place).otherwise(len(categories) + 1)
    return df.orderBy(place, *map(col, then))


def symmetric_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys found on one side only, with the side."""
    return key_difference(left, right, key)


def shuffled(df: DataFrame, row_key: str, seed: int = 0) -> DataFrame:
    """Rows in seeded random order (a range sort on the hash)."""
    return df.withColumn("__u", uniform(seed, "shuffle", col(row_key))).orderBy(
        "__u", col(row_key)
    ).drop("__u")


#: Largest rate of one Poisson draw; larger ones are sums of independent draws.
RATE = 50.0


def poisson_thresholds(rate: float) -> list[float]:
    """P(copies <= n) for n = 0, 1, ... of a Poisson variable, until the rest is below 2^-53."""
    term = upto = exp(-rate)
    out, n = [upto], 0
    while n < rate or term > 2.0**-53:
        n += 1
        term *= rate / n
        upto += term
        out.append(upto)
    return out


def sample_with_replacement(
    df: DataFrame, row_key: str, fraction: float, seed: int = 0
) -> DataFrame:
    """Bootstrap sample: every row appears Poisson(``fraction``) times, by its own hash.

    The copies of one row are bounded by the tail of the Poisson law, so nothing skews.
    """
    copies, draws = F.lit(0), max(1, ceil(fraction / RATE))
    for k in range(draws):
        u = uniform(seed, f"bootstrap{k or ''}", col(row_key))
        for threshold in poisson_thresholds(fraction / draws):
            copies = copies + (u >= F.lit(threshold)).cast("int")
    return df.withColumn("__copies", copies).where("__copies > 0").select(
        *map(col, df.columns), F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("copy")
    )


def attach_range(df: DataFrame, column: str, low: str, high: str) -> DataFrame:
    """Global minimum and maximum on every row, as literals of one aggregate row: no join."""
    row = df.agg(F.min(col(column)).alias("lo"), F.max(col(column)).alias("hi")).first()
    return df.withColumns({low: F.lit(row["lo"]), high: F.lit(row["hi"])})


def downsample_series(
    df: DataFrame,
    id_variable: str,
    time_variable: str,
    row_key: str,
    proportion: float,
    *,
    max_series: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Keep ``int(proportion * n)`` evenly spaced rows of each series, first and last included.

    Positions are ``floor`` of evenly spaced points in [0, n - 1]. ``max_series`` keeps only the
    first series by id (a top-k report).
    """
    if max_series is not None:
        ids = df.select(col(id_variable)).distinct().orderBy(col(id_variable)).limit(max_series)
        df = df.join(ids, id_variable, "left_semi")
    ranked = scan(
        df, [id_variable], [time_variable, row_key], ordinal="__at", size="__n",
        max_group_rows=max_group_rows,
    )
    at, n = (F.col("__at") - 1).cast("bigint"), F.col("__n")
    points = F.floor(F.lit(proportion) * n).cast("bigint")
    # row `at` is kept when some j in [0, points) has floor(j * (n-1) / (points-1)) = at
    step = (n - 1) / (points - 1)
    j = F.ceil(at / step).cast("bigint")
    hit = F.lit(False)
    for k in (j - 1, j, j + 1):
        hit = hit | ((k >= 0) & (k < points) & (F.floor(k * step) == at))
    keep = (
        F.when(points <= 0, F.lit(False))
        .when(points == 1, at == 0)
        .when(at == n - 1, F.lit(True))
        .when(points >= n, F.lit(True))
        .otherwise(hit)
    )
    return ranked.where(keep).select(*map(col, df.columns))
