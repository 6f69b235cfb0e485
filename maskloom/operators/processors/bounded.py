"""Differences between consecutive records as proportions of the room left to a bound."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskloom.functions.validation import col, null_counts
from maskloom.operators.affine import value_before
from maskloom.operators.processors import messages as msg
from maskloom.operators.scan import MAX_GROUP_ROWS, GroupProfile, profile_groups, scan


def relative_change(value: Column, origin: Column, lower: float, upper: float) -> Column:
    """Change from ``origin`` to ``value`` over the distance of ``origin`` to the bound ahead."""
    up = F.try_divide(F.abs(value - origin), F.abs(origin - F.lit(upper)))
    down = F.try_divide(-F.abs(value - origin), F.abs(origin - F.lit(lower)))
    return F.coalesce(F.when(value >= origin, up).otherwise(down), F.lit(0.0))


def apply_change(change: Column, origin: Column, lower: float, upper: float) -> Column:
    room = F.when(change >= 0, F.abs(origin - F.lit(upper))).otherwise(F.abs(origin - F.lit(lower)))
    return origin + change * room


def change_map(change: Column, lower: float, upper: float) -> tuple[Column, Column]:
    """(a, b) of the change while the value stays inside the bounds."""
    size = F.abs(change)
    bound = F.when(change >= 0, F.lit(upper)).otherwise(F.lit(lower))
    return F.lit(1.0) - size, size * bound


def bounds(df: DataFrame, columns: Sequence[str]) -> tuple[float, float]:
    """Smallest and largest value over ``columns``; one aggregate row reaches the driver."""
    lows = [F.min(col(c)).cast("double").alias(f"lo{i}") for i, c in enumerate(columns)]
    highs = [F.max(col(c)).cast("double").alias(f"hi{i}") for i, c in enumerate(columns)]
    row = df.agg(*lows, *highs).first()
    n = len(columns)
    return min(row[:n]), max(row[n:])


def profile_changes(
    dest: DataFrame, by: str, seed: str, changes: Sequence[str], limits: tuple[float, float]
) -> tuple[GroupProfile, Column]:
    """Profile of encoded records, with the flag of those outside the affine limits.

    A seed outside the bounds or a change beyond 1 lets values cross a bound, where the absolute
    distances change sign.
    """
    outside = ~col(seed).cast("double").between(*limits)
    for c in changes:
        outside = outside | (F.abs(col(c)) > 1)
    return profile_groups(dest, by, [seed, *changes], outside), outside


def _values_before(
    df: DataFrame,
    by: str,
    order: Sequence[str],
    seed: str,
    changes: Sequence[str],
    limits: tuple[float, float],
    profile: GroupProfile,
    outside: Column,
    max_group_rows: int,
) -> DataFrame:
    """Append ``__before``, the value each record starts from, whatever the length of the group."""
    lower, upper = limits
    ordered = scan(
        df, [by], order, first={"__seed": seed}, ordinal="__ordinal",
        max_group_rows=max_group_rows, sizes=profile.sizes,
    )
    a, b = F.lit(1.0), F.lit(0.0)
    for c in changes:
        next_a, next_b = change_map(col(c).cast("double"), lower, upper)
        a, b = next_a * a, next_a * b + next_b
    ordered = ordered.withColumns({"__ma": a, "__mb": b})
    fields = dict(
        ordinal="__ordinal", a="__ma", b="__mb", seed="__seed", largest=profile.largest,
        output="__before",
    )
    if not profile.flagged:
        out = value_before(ordered, [by], **fields)
    else:
        strays = df.where(outside).select(col(by).alias("__stray")).distinct()
        match = col(by) == F.col("__stray")
        regular = ordered.join(strays, match, "left_anti")
        stray = ordered.join(strays, match, "left_semi")
        out = value_before(regular, [by], **fields).unionByName(
            _stream_before(stray, by, list(changes), limits)
        )
    return out.drop("__seed", "__ordinal", "__ma", "__mb")


def _stream_before(
    df: DataFrame, by: str, changes: list[str], limits: tuple[float, float]
) -> DataFrame:
    """Sequential form for individuals outside the affine limits.

    Rows stream through in (id, ordinal) order with one running value: memory is one Arrow batch.
    """
    lower, upper = limits
    schema = T.StructType([*df.schema.fields, T.StructField("__before", T.DoubleType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, value = None, 0.0
        for pdf in batches:
            steps = pdf[changes].to_numpy(dtype=float)
            before = []
            for ident, seed, row in zip(pdf[by].tolist(), pdf["__seed"].tolist(), steps):
                if ident != current:
                    current, value = ident, float(seed)
                before.append(value)
                for change in row:
                    value += change * abs(value - (upper if change >= 0 else lower))
            yield pdf.assign(__before=before)

    ordered = df.repartition(col(by)).sortWithinPartitions(col(by), "__ordinal")
    return ordered.mapInPandas(run, schema)


@dataclass(frozen=True)
class BoundedCumulatedModel:
    spec: InterRecordBoundedCumulatedDifferenceProcessor

    def preprocess(self, df: DataFrame) -> DataFrame:
        s = self.spec
        profile = s.check_source(df)
        lower, upper = bounds(df, [s.target_variable])
        out = scan(
            df, [s.id_variable], [*s.order_by, s.row_key],
            first={s.new_first_variable_name: s.target_variable},
            lag={"__previous": s.target_variable},
            max_group_rows=s.max_group_rows, sizes=profile.sizes,
        )
        value = col(s.target_variable).cast("double")
        origin = F.coalesce(F.col("__previous").cast("double"), value)
        change = relative_change(value, origin, lower, upper)
        return out.withColumn(s.new_difference_variable_name, change).drop(
            s.target_variable, "__previous"
        )

    def postprocess(self, source: DataFrame, dest: DataFrame) -> DataFrame:
        s = self.spec
        limits = s.check_columns(source, dest)
        change = s.new_difference_variable_name
        profile, outside = profile_changes(
            dest, s.id_variable, s.new_first_variable_name, [change], limits
        )
        s.check_profile(profile)
        out = _values_before(
            dest, s.id_variable, [*s.order_by, s.row_key], s.new_first_variable_name, [change],
            limits, profile, outside, s.max_group_rows,
        )
        value = apply_change(col(change).cast("double"), F.col("__before"), *limits)
        if s.should_round_output:
            value = F.rint(value).cast("bigint")
        kept = [c for c in dest.columns if c not in (change, s.new_first_variable_name)]
        return out.select(*map(col, kept), value.alias(s.target_variable))


@dataclass(frozen=True)
class InterRecordBoundedCumulatedDifferenceProcessor:
    """Each record as a share of the way from the previous value to the bound it moves towards.

    Records keep the order of ``order_by`` (then the row key).
    """

    id_variable: str
    target_variable: str
    new_first_variable_name: str
    new_difference_variable_name: str
    row_key: str
    order_by: tuple[str, ...] = ()
    should_round_output: bool = False
    max_group_rows: int = MAX_GROUP_ROWS

    def fit(self, df: DataFrame) -> BoundedCumulatedModel:
        return BoundedCumulatedModel(self)

    def check_source(self, df: DataFrame) -> GroupProfile:
        for role in ("id_variable", "target_variable"):
            if getattr(self, role) not in df.columns:
                raise ValueError(msg.COLUMN_INVALID.format(role=role, name=getattr(self, role)))
        profile = profile_groups(df, self.id_variable, [self.target_variable])
        if profile.nulls[self.id_variable]:
            raise ValueError(msg.ID_NULLS)
        if profile.nulls[self.target_variable]:
            raise ValueError(msg.TARGET_NULLS)
        return profile

    def check_columns(self, source: DataFrame, dest: DataFrame) -> tuple[float, float]:
        """Columns of both tables and nulls of the source; returns the bounds."""
        for role in ("new_first_variable_name", "new_difference_variable_name"):
            if getattr(self, role) not in dest.columns:
                raise ValueError(msg.COLUMN_INVALID.format(role=role, name=getattr(self, role)))
        nulls = null_counts(source, [self.id_variable, self.target_variable])
        if nulls[self.id_variable]:
            raise ValueError(msg.ID_NULLS_SOURCE)
        if nulls[self.target_variable]:
            raise ValueError(msg.TARGET_NULLS_SOURCE)
        return bounds(source, [self.target_variable])

    def check_profile(self, profile: GroupProfile) -> None:
        for role in ("new_difference_variable_name", "new_first_variable_name"):
            if profile.nulls[getattr(self, role)]:
                raise ValueError(msg.COLUMN_NULLS.format(role=role))


@dataclass(frozen=True)
class BoundedRangeModel:
    spec: InterRecordBoundedRangeDifferenceProcessor

    def preprocess(self, df: DataFrame) -> DataFrame:
        s = self.spec
        profile = s.check_source(df)
        start, end = s.target_start_variable, s.target_end_variable
        lower, upper = bounds(df, [start, end])
        out = scan(
            df, [s.id_variable], s.order,
            first={s.new_first_variable_name: start}, lag={"__previous_end": end},
            max_group_rows=s.max_group_rows, sizes=profile.sizes,
        )
        begin, finish = col(start).cast("double"), col(end).cast("double")
        origin = F.coalesce(F.col("__previous_end").cast("double"), begin)
        kept = [c for c in df.columns if c not in (start, end)]
        return out.select(
            *map(col, kept),
            relative_change(finish, begin, lower, upper).alias(s.new_range_variable),
            col(s.new_first_variable_name),
            relative_change(begin, origin, lower, upper).alias(s.new_difference_variable_name),
        )

    def postprocess(self, source: DataFrame, dest: DataFrame) -> DataFrame:
        s = self.spec
        limits = bounds(source, [s.target_start_variable, s.target_end_variable])
        gap, length = s.new_difference_variable_name, s.new_range_variable
        profile, outside = profile_changes(
            dest, s.id_variable, s.new_first_variable_name, [gap, length], limits
        )
        out = _values_before(
            dest, s.id_variable, s.order, s.new_first_variable_name, [gap, length], limits,
            profile, outside, s.max_group_rows,
        )
        begin = apply_change(col(gap).cast("double"), F.col("__before"), *limits)
        out = out.withColumn("__begin", begin)
        finish = apply_change(col(length).cast("double"), F.col("__begin"), *limits)
        begin = F.col("__begin")
        if s.should_round_output:
            begin, finish = s.to_integer(begin), s.to_integer(finish)
        created = {gap, length, s.new_first_variable_name}
        out = out.withColumns({s.target_start_variable: begin, s.target_end_variable: finish})
        targets = [s.target_start_variable, s.target_end_variable]
        found = [c for c in dest.columns if c not in created] + targets
        common = [c for c in source.columns if c in found]
        return out.select(*map(col, common + [c for c in found if c not in common]))


@dataclass(frozen=True)
class InterRecordBoundedRangeDifferenceProcessor:
    """Range start and end as shares of the room to the bounds.

    ``integer_mode`` "round" (default) keeps integer round trips exact; "truncate" drops decimals.
    """

    id_variable: str
    target_start_variable: str
    target_end_variable: str
    new_first_variable_name: str
    new_range_variable: str
    new_difference_variable_name: str
    row_key: str
    sort_by_variable: str | None = None
    order_by: tuple[str, ...] = ()
    should_round_output: bool = True
    integer_mode: str = "round"
    max_group_rows: int = MAX_GROUP_ROWS

    def __post_init__(self) -> None:
        if self.integer_mode not in ("round", "truncate"):
            raise ValueError(f"Expected 'round' or 'truncate', got {self.integer_mode!r} instead")

    @property
    def order(self) -> list[str]:
        sort = [self.sort_by_variable] if self.sort_by_variable else []
        return [*sort, *self.order_by, self.row_key]

    def to_integer(self, value: Column) -> Column:
        return (F.rint(value) if self.integer_mode == "round" else value).cast("bigint")

    def fit(self, df: DataFrame) -> BoundedRangeModel:
        return BoundedRangeModel(self)

    def check_source(self, df: DataFrame) -> GroupProfile:
        roles = ("id_variable", "target_start_variable", "target_end_variable", "sort_by_variable")
        names = [getattr(self, r) for r in roles]
        present = [n for n in names if n]
        if set(present) - set(df.columns):
            raise ValueError(
                msg.COLUMNS_INVALID.format(roles=msg.tick(*roles), names=msg.quote(*names))
            )
        profile = profile_groups(df, self.id_variable, present)
        if any(profile.nulls.values()):
            raise ValueError(msg.COLUMNS_NULLS.format(roles=msg.tick(*roles)))
        return profile
