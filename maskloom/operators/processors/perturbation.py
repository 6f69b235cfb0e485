"""Synthetic values pulled back towards their source."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.functions.uniform import uniform
from maskloom.functions.validation import col, is_number
from maskloom.operators.processors import messages as msg


@dataclass(frozen=True)
class PerturbationProcessor:
    """``level`` 0 gives the source back, 1 keeps the synthetic value.

    Numbers move linearly; categories are taken from the synthetic row with probability ``level``.
    Source and synthetic rows are matched on ``row_key``; synthetic rows without a source row stay as they
    are.
    """

    row_key: str
    perturbation_level: Mapping[str, float] | None = None
    seed: int = 0

    def fit(self, df: DataFrame) -> PerturbationProcessor:
        return self

    def preprocess(self, df: DataFrame) -> DataFrame:
        return df

    def postprocess(self, source: DataFrame, dest: DataFrame) -> DataFrame:
        levels = dict(self.perturbation_level or {})
        missing = set(levels) - set(source.columns)
        if missing:
            raise ValueError("perturbation_level", msg.PERTURBATION_NOT_FOUND.format(names=missing))
        levels = {c: v for c, v in levels.items() if v != 1.0}
        if not levels:
            return dest
        twin = source.select(col(self.row_key), *[col(c).alias(f"__src_{c}") for c in levels],
                             F.lit(True).alias("__twin"))
        joined = dest.join(twin, self.row_key, "left")
        numbers = {f.name for f in dest.schema.fields if is_number(f)}
        columns = {}
        for c, level in levels.items():
            before, after = col(f"__src_{c}"), col(c)
            if c in numbers:
                value = before + (after - before) * F.lit(float(level))
            else:
                drawn = uniform(self.seed, f"perturb:{c}", col(self.row_key)) < F.lit(float(level))
                value = F.when(drawn, after).otherwise(before)
            columns[c] = F.when(col("__twin"), value).otherwise(after)
        return joined.withColumns(columns).select(*map(col, dest.columns))
