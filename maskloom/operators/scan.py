"""Ordered per-group columns (first, lag, running sum, ordinal, size, totals) that survive hot groups.

A window partitioned by the group alone sorts one group inside one task. That is the cheapest plan
while every group is moderate: one shuffle, one sort. When one group outgrows ``max_group_rows`` the
rows are range-partitioned by (group, order) instead, so a hot group spreads over many partitions;
windows then run per (partition, group) and only the groups that straddle a boundary need a carry.
A range partition has two boundaries, so the carry table has at most two rows per partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskloom.functions.validation import col, missing
from maskloom.session import materialize

MAX_GROUP_ROWS = 2_000_000
PART = "__part"

MERGE = {"sum": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class GroupProfile:
    """What one pass over a grouped table tells: group sizes, missing values and a flag."""

    largest: int
    rows: int
    nulls: Mapping[str, int]
    flagged: bool

    @property
    def sizes(self) -> tuple[int, int]:
        return self.largest, self.rows


def profile_groups(
    df: DataFrame, by: str, checked: Sequence[str] = (), flag: Column | None = None
) -> GroupProfile:
    """Sizes per group, nulls of ``by`` and ``checked``, and whether ``flag`` holds anywhere.

    Counts are combined before the only shuffle, so a hot group is one row per map task.
    """
    others = [c for c in dict.fromkeys(checked) if c != by]
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.count_if(missing(df, c)).alias(f"m{i}") for i, c in enumerate(others)]
    aggs.append(F.max(F.coalesce(flag, F.lit(False)) if flag is not None else F.lit(False)).alias("f"))
    groups = df.groupBy(col(by).alias("g")).agg(*aggs)
    row = groups.agg(
        F.max("n").alias("largest"), F.sum("n").alias("rows"),
        F.sum(F.when(F.col("g").isNull(), F.col("n"))).alias("keyless"), F.max("f").alias("f"),
        *[F.sum(f"m{i}").alias(f"m{i}") for i in range(len(others))],
    ).first()
    nulls = {by: int(row["keyless"] or 0)}
    nulls |= {c: int(row[f"m{i}"] or 0) for i, c in enumerate(others)}
    return GroupProfile(int(row["largest"] or 0), int(row["rows"] or 0), nulls, bool(row["f"]))


def group_sizes(df: DataFrame, by: Sequence[str]) -> tuple[int, int]:
    """(rows of the largest group, rows in total); counts are combined before the shuffle."""
    sizes = df.groupBy(*map(col, by)).count()
    row = sizes.agg(F.max("count").alias("largest"), F.sum("count").alias("total")).first()
    return int(row["largest"] or 0), int(row["total"] or 0)


def scan(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    *,
    first: Mapping[str, str] | None = None,
    lag: Mapping[str, str] | None = None,
    cumsum: Mapping[str, str] | None = None,
    total: Mapping[str, tuple[str, str]] | None = None,
    ordinal: str | None = None,
    size: str | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
    sizes: tuple[int, int] | None = None,
) -> DataFrame:
    """Append ordered columns to ``df``.

    ``first``, ``lag`` and ``cumsum`` map new names to source columns; ``total`` maps a new name to
    (``sum`` | ``min`` | ``max``, column) over the whole group; ``ordinal`` counts rows from 1.
    ``order`` must end in a unique row key. ``sizes`` passes a known :func:`group_sizes`.
    """
    first, lag, cumsum, total = (dict(m or {}) for m in (first, lag, cumsum, total))
    largest, rows = sizes if sizes is not None else group_sizes(df, by)
    if largest <= max_group_rows:
        return df.withColumns(_local(by, order, first, lag, cumsum, total, ordinal, size))

    parts = max(2, 2 * ceil(rows / max_group_rows))
    keys = [col(c) for c in [*by, *order]]
    base = materialize(
        df.repartitionByRange(parts, *keys).withColumn(PART, F.spark_partition_id())
    )
    local_by = [PART, *by]
    local = base.withColumns(
        _local(local_by, order, {}, lag, cumsum, {}, "__ordinal", None)
    )
    carry = _carry(base, by, order, first, lag, cumsum, total)
    match = F.col("l." + PART) == F.col("r." + PART)
    for name in by:
        match = match & _side("l", name).eqNullSafe(_side("r", name))
    joined = local.alias("l").join(F.broadcast(carry.alias("r")), match, "left")

    # a group inside one partition has no carry row: its local window is already complete
    whole = Window.partitionBy(*[_side("l", c) for c in local_by])
    ordered = whole.orderBy(*[_side("l", c) for c in order]).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    is_split = F.col("r.__rows").isNotNull()
    out: list[Column] = [_side("l", c).alias(c) for c in df.columns]
    for name, source in first.items():
        here = F.first(_side("l", source)).over(ordered)
        out.append(F.when(is_split, F.col(f"r.__first_{name}")).otherwise(here).alias(name))
    for name in lag:
        opens = F.col("l.__ordinal") == 1
        out.append(F.when(opens, F.col(f"r.__lag_{name}")).otherwise(_side("l", name)).alias(name))
    for name in cumsum:
        # NULL until the first value: of the partition (local) and of the group (before)
        local_sum, before = _side("l", name), F.col(f"r.__sum_{name}")
        out.append(F.coalesce(local_sum + before, local_sum, before).alias(name))
    for name, (kind, source) in total.items():
        here = MERGE[kind](_side("l", source)).over(whole)
        out.append(F.when(is_split, F.col(f"r.__total_{name}")).otherwise(here).alias(name))
    if ordinal:
        before = F.coalesce(F.col("r.__before"), F.lit(0))
        out.append((F.col("l.__ordinal") + before).alias(ordinal))
    if size:
        here = F.count(F.lit(1)).over(whole)
        out.append(F.when(is_split, F.col("r.__rows")).otherwise(here).alias(size))
    return joined.select(*out)


def _side(alias: str, name: str) -> Column:
    return F.col(f"{alias}.`" + name.replace("`", "``") + "`")


def _local(by, order, first, lag, cumsum, total, ordinal, size) -> dict[str, Column]:
    whole = Window.partitionBy(*map(col, by))
    ordered = whole.orderBy(*map(col, order))
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = {n: F.first(col(c)).over(running) for n, c in first.items()}
    out |= {n: F.lag(col(c)).over(ordered) for n, c in lag.items()}
    out |= {n: F.sum(col(c)).over(running) for n, c in cumsum.items()}
    out |= {n: MERGE[kind](col(c)).over(whole) for n, (kind, c) in total.items()}
    if ordinal:
        out[ordinal] = F.row_number().over(ordered).cast("bigint")
    if size:
        out[size] = F.count(F.lit(1)).over(whole)
    return out


def _carry(base, by, order, first, lag, cumsum, total) -> DataFrame:
    """What each (partition, group) must add, for the groups found in several partitions."""
    place = F.struct(*map(col, order))
    aggs = [F.count(F.lit(1)).alias("__n")]
    aggs += [F.min_by(col(c), place).alias(f"__head_{n}") for n, c in first.items()]
    aggs += [F.max_by(col(c), place).alias(f"__tail_{n}") for n, c in lag.items()]
    aggs += [F.sum(col(c)).alias(f"__part_{n}") for n, c in cumsum.items()]
    aggs += [MERGE[kind](col(c)).alias(f"__agg_{n}") for n, (kind, c) in total.items()]
    summary = base.groupBy(F.col(PART), *map(col, by)).agg(*aggs)

    whole = Window.partitionBy(*map(col, by))
    ordered = whole.orderBy(PART)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = {
        "__pieces": F.count(F.lit(1)).over(whole),
        "__rows": F.sum("__n").over(whole),
        "__before": F.coalesce(F.sum("__n").over(before), F.lit(0)),
    }
    out |= {f"__first_{n}": F.first(f"__head_{n}").over(upto) for n in first}
    out |= {f"__lag_{n}": F.lag(f"__tail_{n}").over(ordered) for n in lag}
    out |= {f"__sum_{n}": F.sum(f"__part_{n}").over(before) for n in cumsum}
    out |= {f"__total_{n}": MERGE[k](f"__agg_{n}").over(whole) for n, (k, _) in total.items()}
    return summary.withColumns(out).where("__pieces > 1")
