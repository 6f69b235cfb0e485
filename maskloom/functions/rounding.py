"""Rounding that keeps the sum.

Closed form: round every item, see by how many units of the last decimal the rounded sum misses the
target, and hand those units out in order of the strategy. ``Column.round`` rounds halves away from
zero.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom.functions.sizing import broadcast_if_small
from maskloom.functions.validation import col
from maskloom.operators.scan import MAX_GROUP_ROWS, scan
from maskloom.session import materialize

DIFFERENCE, LARGEST, SMALLEST = "difference", "largest", "smallest"
STRATEGIES = (DIFFERENCE, LARGEST, SMALLEST)


def check_strategy(strategy: str) -> None:
    if strategy not in STRATEGIES:
        raise ValueError(f"Expected a valid RoundingStrategy, got {strategy} instead.")


def _unit(value: Column, places: int) -> Column:
    """10**-places as a column-free factor that stays exact for negative places."""
    return value / F.lit(float(10**places)) if places >= 0 else value * F.lit(float(10**-places))


def _units(value: Column, places: int) -> Column:
    scaled = value * F.lit(float(10**places)) if places >= 0 else value / F.lit(float(10**-places))
    return F.round(scaled, 0).cast("bigint")


def saferound_columns(
    df: DataFrame,
    columns: Sequence[str],
    places: int,
    *,
    strategy: str = DIFFERENCE,
    topline: str | None = None,
) -> DataFrame:
    """Replace ``columns`` (doubles) by rounded values whose row sum is the rounded original sum.

    ``topline`` names a column holding another sum to match. Rows with a null among ``columns`` stay
    as they are. Everything is a row expression: no shuffle.
    """
    check_strategy(strategy)
    if not columns:
        return df
    m = len(columns)
    complete = F.lit(True)
    for c in columns:
        complete = complete & col(c).isNotNull()
    total = F.lit(0.0)
    for c in columns:
        total = total + col(c)
    goal = F.round(col(topline).cast("double") if topline else total, places)

    step = {f"__r{i}": F.round(col(c), places) for i, c in enumerate(columns)}
    df1 = df.withColumns({**step, "__goal": goal})
    rounded_sum = F.lit(0.0)
    for i in range(m):
        rounded_sum = rounded_sum + F.col(f"__r{i}")
    df2 = df1.withColumn("__n", _units(F.col("__goal") - rounded_sum, places))
    sign = F.signum(F.col("__n").cast("double"))
    if strategy == DIFFERENCE:
        # missing units go to the items rounded down most, surplus is taken where rounded up most
        rank_by = {f"__o{i}": (F.col(f"__r{i}") - col(c)) * sign for i, c in enumerate(columns)}
    else:
        turn = F.lit(-1.0 if strategy == LARGEST else 1.0)
        rank_by = {f"__o{i}": F.col(f"__r{i}") * turn for i in range(m)}
    df3 = df2.withColumns(rank_by)
    out = {}
    each = F.floor(F.abs(F.col("__n")) / m).cast("bigint")
    extra = F.abs(F.col("__n")) % m
    for i, c in enumerate(columns):
        ahead = F.lit(0)
        for j in range(m):
            if j != i:
                mine, other = F.col(f"__o{i}"), F.col(f"__o{j}")
                wins = (other < mine) | (other == mine) if j < i else other < mine
                ahead = ahead + wins.cast("int")
        units = (each + (ahead < extra).cast("bigint")).cast("double") * sign
        value = F.round(F.col(f"__r{i}") + _unit(units, places), places)
        out[c] = F.when(complete, value).otherwise(col(c))
    return df3.withColumns(out).select(*map(col, df.columns))


def saferound_groups(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    row_key: str,
    places: int,
    *,
    strategy: str = DIFFERENCE,
    output: str = "rounded",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Round ``value`` so that every group keeps its rounded total.

    Group sums come from a map-side combined aggregate; the order inside a group comes from
    :func:`scan`, so a hot group is never sorted in one task. Rows without a value take no part and keep
    NULL as their output.
    """
    check_strategy(strategy)
    keep = {"__rounded": F.round(col(value), places)}
    df1 = df.withColumns(keep).where(col(value).isNotNull())
    per_group = df1.groupBy(*map(col, by)).agg(
        F.sum(col(value)).alias("__total"),
        F.sum("__rounded").alias("__rounded_total"),
        F.count(F.lit(1)).alias("__size"),
    )
    gap = F.round(F.col("__total"), places) - F.col("__rounded_total")
    per_group = per_group.select(
        *[col(c).alias(f"__g{i}") for i, c in enumerate(by)], "__size",
        _units(gap, places).alias("__n"),
    )
    per_group = materialize(per_group)
    shape = per_group.agg(F.max("__size").alias("largest"), F.sum("__size").alias("rows")).first()
    match = F.lit(True)
    for i, c in enumerate(by):
        match = match & col(c).eqNullSafe(F.col(f"__g{i}"))
    df2 = df1.join(broadcast_if_small(per_group), match, "inner")
    sign = F.signum(F.col("__n").cast("double"))
    if strategy == DIFFERENCE:
        place = (F.col("__rounded") - col(value)) * sign
    else:
        place = F.col("__rounded") * F.lit(-1.0 if strategy == LARGEST else 1.0)
    # the error is compared at 12 decimals, so that noise in the last bits cannot reorder ties
    df3 = df2.withColumn("__place", F.round(place, 12))
    ranked = scan(
        df3, by, ["__place", row_key], ordinal="__rank", max_group_rows=max_group_rows,
        sizes=(shape["largest"] or 0, shape["rows"] or 0),
    )
    each = F.floor(F.abs(F.col("__n")) / F.col("__size")).cast("bigint")
    extra = F.abs(F.col("__n")) % F.col("__size")
    units = (each + (F.col("__rank") <= extra).cast("bigint")).cast("double") * sign
    result = F.round(F.col("__rounded") + _unit(units, places), places)
    done = ranked.select(*map(col, df.columns), result.alias(output))
    without = df.where(col(value).isNull())
    return done.unionByName(without.withColumn(output, F.lit(None).cast(done.schema[output].dataType)))
