"""Group means (and standard deviations) forced back to those of the reference data."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.functions.sizing import broadcast_if_small
from maskloom.functions.validation import col
from maskloom.operators.profile import grouped_mean_std
from maskloom.session import materialize


@dataclass(frozen=True)
class ExpectedMeanModel:
    targets: tuple[str, ...]
    by: tuple[str, ...]
    same_std: bool
    statistics: DataFrame

    def preprocess(self, df: DataFrame) -> DataFrame:
        return df

    def postprocess(self, source: DataFrame, dest: DataFrame) -> DataFrame:
        current = grouped_mean_std(dest, self.targets, self.by)
        if self.by:
            current = materialize(current)
        keep_std = {c: self.same_std for c in self.targets}
        if self.same_std:
            flags = current.agg(
                *[F.max(col(f"{c}std") == 0).alias(c) for c in self.targets]
            ).first().asDict()
            for c in self.targets:
                if flags[c]:
                    warnings.warn(
                        f"target variable {c} has a std of 0. The same standard deviation cannot "
                        "be guaranteed for this variable.",
                        stacklevel=2,
                    )
                    keep_std[c] = False
        if not self.by:
            return self._shift_all(dest, current, keep_std)
        statistics = [f"{c}{s}" for c in self.targets for s in ("mean", "std")]
        keys = [f"__k{i}" for i in range(len(self.by))]
        renamed = [col(c).alias(k) for c, k in zip(self.by, keys)]
        now = current.select(*renamed, *[col(s).alias(f"__now_{s}") for s in statistics])
        want = self.statistics.select(
            *[col(c).alias(f"__want{k}") for c, k in zip(self.by, keys)],
            *[col(s).alias(f"__want_{s}") for s in statistics],
        )
        both = F.lit(True)
        for k in keys:
            both = both & F.col(k).eqNullSafe(F.col(f"__want{k}"))
        # the two group tables meet first, so that the rows are joined once
        shift = materialize(now.join(want, both, "inner"))
        match = F.lit(True)
        for c, k in zip(self.by, keys):
            match = match & col(c).eqNullSafe(F.col(k))
        joined = dest.join(broadcast_if_small(shift), match, "inner")
        columns = {}
        for c in self.targets:
            centred = col(c) - col(f"__now_{c}mean")
            if keep_std[c]:
                centred = centred * F.try_divide(col(f"__want_{c}std"), col(f"__now_{c}std"))
            columns[c] = col(f"__want_{c}mean") + centred
        return joined.withColumns(columns).select(*map(col, dest.columns))


    def _shift_all(self, dest: DataFrame, current: DataFrame, keep_std: dict) -> DataFrame:
        """Without groups the statistics are one row each and become literals: no join."""
        now, want = current.first().asDict(), self.statistics.first().asDict()
        columns = {}
        for c in self.targets:
            centred = col(c) - F.lit(now[f"{c}mean"])
            if keep_std[c]:
                centred = centred * F.try_divide(
                    F.lit(want[f"{c}std"]), F.lit(now[f"{c}std"])
                )
            columns[c] = F.lit(want[f"{c}mean"]) + centred
        return dest.withColumns(columns)


@dataclass(frozen=True)
class ExpectedMeanProcessor:
    """Groups missing from the reference drop out (inner join); null groups match each other."""

    target_variables: Sequence[str]
    groupby_variables: Sequence[str] | None = None
    same_std: bool = False

    def fit(self, df: DataFrame) -> ExpectedMeanModel:
        by = tuple(self.groupby_variables or ())
        statistics = materialize(grouped_mean_std(df, self.target_variables, by))
        return ExpectedMeanModel(tuple(self.target_variables), by, self.same_std, statistics)
