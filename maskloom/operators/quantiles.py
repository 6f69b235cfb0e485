"""Exact quantiles that never hold one group's values in one buffer."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, floor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.functions.validation import col
from maskloom.operators.scan import MAX_GROUP_ROWS, scan

SMALL = 200_000
ACCURACY = 10_000


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> list[float]:
    """Linearly interpolated quantiles of one column (nulls skipped).

    Small columns use the built-in exact aggregate. Larger ones narrow a value bracket around each
    wanted rank with mergeable sketches until the bracket is small; every step is one map-side
    combined pass.
    """
    values = df.select(col(column).cast("double").alias("v")).where("v is not null")
    n = values.count()
    if n == 0:
        return [None for _ in probabilities]
    if n <= SMALL:
        wanted = F.array(*[F.lit(float(p)) for p in probabilities])
        return list(values.agg(F.percentile("v", wanted).alias("q")).first()["q"])
    ranks = {}
    for p in probabilities:
        position = p * (n - 1)
        for rank in {floor(position), ceil(position)}:
            if rank not in ranks:
                ranks[rank] = value_at_rank(values, rank, n)
    out = []
    for p in probabilities:
        position = p * (n - 1)
        low, high = ranks[floor(position)], ranks[ceil(position)]
        out.append(low + (position - floor(position)) * (high - low))
    return out


def value_at_rank(values: DataFrame, rank: int, n: int, small: int = SMALL) -> float:
    """Value at 0-based ``rank`` among the ``n`` doubles in column ``v``."""
    part, before, size = values, 0, n
    while size > small:
        margin = 3.0 / ACCURACY
        share = (rank - before + 0.5) / size
        edges = [max(0.0, share - margin), min(1.0, share + margin)]
        low, high = part.agg(
            F.percentile_approx("v", [float(e) for e in edges], ACCURACY).alias("q")
        ).first()["q"]
        v = F.col("v")
        row = part.agg(
            F.count_if(v < low).alias("under"), F.count_if(v == low).alias("at_low"),
            F.count_if((v > low) & (v < high)).alias("inner"),
            F.count_if((v == high) & (v > low)).alias("at_high"),
        ).first()
        # ties at the bracket ends answer at once, so every round strictly shrinks the rest
        place = rank - before
        if place < row["under"]:
            part, size = part.where(v < low), row["under"]
            continue
        place -= row["under"]
        if place < row["at_low"]:
            return low
        place -= row["at_low"]
        if place < row["inner"]:
            part, size = part.where((v > low) & (v < high)), row["inner"]
            before = rank - place
            continue
        place -= row["inner"]
        if place < row["at_high"]:
            return high
        place -= row["at_high"]
        size -= row["under"] + row["at_low"] + row["inner"] + row["at_high"]
        part, before = part.where(v > high), rank - place
    position = min(1.0, max(0.0, (rank - before) / max(size - 1, 1)))
    return part.agg(F.percentile("v", F.lit(position)).alias("q")).first()["q"]


def grouped_quantiles(
    df: DataFrame,
    by: Sequence[str],
    column: str,
    probabilities: Sequence[float],
    *,
    prefix: str = "q",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Exact quantiles per group as ``<prefix>0, <prefix>1, ...``.

    Equal values collapse on the map side; the running count over distinct values is a
    :func:`scan`, so a hot group is spread over range partitions.
    """
    counted = (
        df.where(col(column).isNotNull())
        .groupBy(*map(col, by), col(column).cast("double").alias("__v"))
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    ranked = scan(
        counted, by, ["__v"], cumsum={"__upto": "__n"}, total={"__all": ("sum", "__n")},
        max_group_rows=max_group_rows,
    )
    picks, outs = [], []
    for i, p in enumerate(probabilities):
        position = F.lit(float(p)) * (F.col("__all") - 1)
        for side, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            covers = (rank >= F.col("__upto") - F.col("__n")) & (rank < F.col("__upto"))
            picks.append(F.max(F.when(covers, F.col("__v"))).alias(f"__{side}{i}"))
        share = F.lit(float(p)) * (F.col("__total") - 1)
        part = share - F.floor(share)
        low, high = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        outs.append((low + part * (high - low)).alias(f"{prefix}{i}"))
    picked = ranked.groupBy(*map(col, by)).agg(F.max("__all").alias("__total"), *picks)
    return picked.select(*map(col, by), *outs)
