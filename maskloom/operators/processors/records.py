"""Unbounded differences between consecutive records of one individual."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.functions.validation import col, has_nulls, null_counts, same_keys
from maskloom.operators.processors import messages as msg
from maskloom.operators.scan import MAX_GROUP_ROWS, profile_groups, scan


def in_source_order(dest, source, row_key, order_columns):
    """``dest`` with the order columns of ``source`` attached by row key."""
    if not same_keys(source, dest, row_key):
        raise ValueError(msg.SAME_KEYS)
    names = [f"__order_{i}" for i in range(len(order_columns))]
    ranks = source.select(col(row_key), *[col(c).alias(n) for c, n in zip(order_columns, names)])
    return dest.join(ranks, row_key, "inner").select(*map(col, dest.columns), *names), names


@dataclass(frozen=True)
class InterRecordCumulatedDifferenceProcessor:
    """A cumulative variable as its first value per individual plus step differences.

    Records are ordered by (id, target, row key). ``order_by`` gives the row order of synthetic data
    when decoding; with ``keep_record_order`` the order of the source rows is used instead.
    """

    id_variable: str
    target_variable: str
    new_first_variable_name: str
    new_difference_variable_name: str
    row_key: str
    order_by: tuple[str, ...] = ()
    keep_record_order: bool = False
    max_group_rows: int = MAX_GROUP_ROWS

    def fit(self, df: DataFrame) -> InterRecordCumulatedDifferenceProcessor:
        return self

    def preprocess(self, df: DataFrame) -> DataFrame:
        for role in ("id_variable", "target_variable"):
            if getattr(self, role) not in df.columns:
                raise ValueError(msg.COLUMN_INVALID.format(role=role, name=getattr(self, role)))
        profile = profile_groups(df, self.id_variable, [self.target_variable])
        if profile.nulls[self.id_variable]:
            raise ValueError(msg.ID_NULLS)
        if profile.nulls[self.target_variable]:
            raise ValueError(msg.TARGET_NULLS)
        out = scan(
            df,
            [self.id_variable],
            [self.target_variable, self.row_key],
            first={self.new_first_variable_name: self.target_variable},
            lag={"__previous": self.target_variable},
            max_group_rows=self.max_group_rows,
            sizes=profile.sizes,
        )
        step = F.coalesce(col(self.target_variable) - F.col("__previous"), F.lit(0)).cast("double")
        return out.withColumn(self.new_difference_variable_name, step).drop(
            self.target_variable, "__previous"
        )

    def postprocess(self, source: DataFrame, dest: DataFrame) -> DataFrame:
        roles = ("new_first_variable_name", "new_difference_variable_name")
        for role in roles:
            if getattr(self, role) not in dest.columns:
                raise ValueError(msg.COLUMN_INVALID.format(role=role, name=getattr(self, role)))
        nulls = null_counts(source, [self.id_variable, self.target_variable])
        if nulls[self.id_variable]:
            raise ValueError(msg.ID_NULLS_SOURCE)
        if nulls[self.target_variable]:
            raise ValueError(msg.TARGET_NULLS_SOURCE)
        profile = profile_groups(dest, self.id_variable, [getattr(self, r) for r in roles])
        for role in reversed(roles):
            if profile.nulls[getattr(self, role)]:
                raise ValueError(msg.COLUMN_NULLS.format(role=role))
        order = list(self.order_by)
        working = dest
        if self.keep_record_order:
            working, order = in_source_order(dest, source, self.row_key, [self.target_variable])
        out = scan(
            working,
            [self.id_variable],
            [*order, self.row_key],
            cumsum={"__moved": self.new_difference_variable_name},
            max_group_rows=self.max_group_rows,
            sizes=profile.sizes,
        )
        value = col(self.new_first_variable_name) + F.col("__moved")
        kept = [c for c in dest.columns if c not in {getattr(self, r) for r in roles}]
        return out.select(*map(col, kept), value.alias(self.target_variable))


@dataclass(frozen=True)
class InterRecordRangeDifferenceProcessor:
    """Start and end of successive ranges as first start, range length and gap to the previous end."""

    id_variable: str
    target_start_variable: str
    target_end_variable: str
    sort_by_variable: str
    new_first_variable: str
    new_range_variable: str
    new_difference_variable: str
    row_key: str
    order_by: tuple[str, ...] = ()
    keep_record_order: bool = False
    max_group_rows: int = MAX_GROUP_ROWS

    def fit(self, df: DataFrame) -> InterRecordRangeDifferenceProcessor:
        return self

    def preprocess(self, df: DataFrame) -> DataFrame:
        roles = ("id_variable", "target_start_variable", "target_end_variable", "sort_by_variable")
        names = [getattr(self, r) for r in roles]
        if set(names) - set(df.columns):
            raise ValueError(
                msg.COLUMNS_INVALID.format(roles=msg.tick(*roles), names=msg.quote(*names))
            )
        profile = profile_groups(df, self.id_variable, names)
        if any(profile.nulls.values()):
            raise ValueError(msg.COLUMNS_NULLS.format(roles=msg.tick(*roles)))
        start, end = self.target_start_variable, self.target_end_variable
        out = scan(
            df,
            [self.id_variable],
            [self.sort_by_variable, self.row_key],
            first={self.new_first_variable: start},
            lag={"__previous_end": end},
            max_group_rows=self.max_group_rows,
            sizes=profile.sizes,
        )
        gap = F.coalesce(col(start) - F.col("__previous_end"), F.lit(0)).cast("double")
        kept = [c for c in df.columns if c not in (start, end)]
        return out.select(
            *map(col, kept),
            (col(end) - col(start)).alias(self.new_range_variable),
            col(self.new_first_variable),
            gap.alias(self.new_difference_variable),
        )

    def postprocess(self, source: DataFrame, dest: DataFrame) -> DataFrame:
        roles = (
            "id_variable", "new_first_variable", "new_range_variable", "new_difference_variable",
        )
        names = [getattr(self, r) for r in roles]
        if set(names) - set(dest.columns):
            raise ValueError(
                msg.COLUMNS_INVALID.format(roles=msg.tick(*roles), names=msg.quote(*names))
            )
        if self.sort_by_variable not in source.columns:
            raise ValueError(
                msg.COLUMN_INVALID.format(
                    role="sort_by_variable", name=f"'{self.sort_by_variable}'"
                )
            )
        profile = profile_groups(dest, self.id_variable, names)
        if any(profile.nulls.values()):
            raise ValueError(msg.COLUMNS_NULLS.format(roles=msg.tick(*roles)))
        if has_nulls(source, [self.sort_by_variable]):
            raise ValueError(msg.SORT_NULLS_SOURCE)
        order = list(self.order_by)
        working = dest
        if self.keep_record_order:
            working, order = in_source_order(dest, source, self.row_key, [self.sort_by_variable])
        out = scan(
            working,
            [self.id_variable],
            [*order, self.row_key],
            cumsum={"__ranges": self.new_range_variable, "__gaps": self.new_difference_variable},
            max_group_rows=self.max_group_rows,
            sizes=profile.sizes,
        )
        # ranges of the earlier records only: the running sum less the record's own range
        earlier = F.col("__ranges") - col(self.new_range_variable)
        begin = col(self.new_first_variable) + (earlier + F.col("__gaps"))
        created = {self.new_first_variable, self.new_range_variable, self.new_difference_variable}
        kept = [c for c in dest.columns if c not in created]
        return out.select(
            *map(col, kept),
            begin.alias(self.target_start_variable),
            (begin + col(self.new_range_variable)).alias(self.target_end_variable),
        )
