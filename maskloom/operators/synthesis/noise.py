"""Differentially private variant: noise on statistics and on every cell.

Mechanism, for a total budget ``epsilon`` per row:

* ``preprocess_budget_ratio * epsilon`` is split evenly over the numeric columns; each spends one half on
  the sum of its clipped values (taken from the middle of the bounds) and one on their number, and its
  mean is the quotient of the two noisy figures. Exact counts are never used.
* the rest is split evenly over all columns. A number is clipped to its public bounds, centred on
  the noisy mean, and gets noise of scale (upper - lower) / share. A category is kept with probability
  e^share / (e^share + m - 1), m the number of listed modalities, otherwise it is one of the other
  modalities, each alike (randomised response).

A column named in ``missing`` (public knowledge as well: which columns can have gaps) spends half of its
share on whether the value is missing, reported by randomised response, and the rest on the value. In
any other column a gap is filled: by the noisy mean plus noise, or by a random modality. Means are over
the values present.

Noise is two-sided geometric on a grid of powers of two, and values are put on that grid first, so the
digits of a double tell nothing. ``budget_ledger`` lists what each step spends; by sequential composition a
row spends their sum, which is ``epsilon`` (without numeric columns the part for means stays unspent). Bounds and modalities must be public knowledge,
not read from the data. The noise is a function of ``seed``: the guarantee holds only if the seed is
secret and random, and used once. Fixed seeds are for tests.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import exp, floor, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom.functions.uniform import discrete_laplace, uniform
from maskloom.functions.validation import INTEGERS, col


def private_rows(
    df: DataFrame,
    row_key: str,
    *,
    epsilon: float,
    bounds: Mapping[str, tuple[float, float]],
    modalities: Mapping[str, Sequence[str]],
    preprocess_budget_ratio: float = 0.5,
    missing: Sequence[str] = (),
    seed: int = 0,
) -> DataFrame:
    """(row_key, columns of ``bounds`` and ``modalities``) with noise; one aggregate, no shuffle."""
    if epsilon <= 0 or not 0 < preprocess_budget_ratio < 1:
        raise ValueError("Expected epsilon > 0 and 0 < preprocess_budget_ratio < 1")
    share = (1 - preprocess_budget_ratio) * epsilon / max(1, len(bounds) + len(modalities))
    types = {f.name: f.dataType for f in df.schema.fields}
    out: list[Column] = [col(row_key)]
    means = noisy_means(df, bounds, epsilon * preprocess_budget_ratio, seed)
    for c, (low, high) in bounds.items():
        own = share / 2 if c in missing else share
        grid = grid_of((high - low) / own)
        centred = F.coalesce(F.round((clip(col(c), low, high) - F.lit(means[c])) / F.lit(grid)) * F.lit(grid), F.lit(0.0))
        noise = discrete_laplace((high - low + grid) / own, grid, seed, f"cell:{c}", col(row_key))
        value = clip(centred + noise + F.lit(means[c]), low, high)
        if isinstance(types[c], INTEGERS):
            value = F.round(value)
        out.append(with_gaps(value.cast(types[c]), c, missing, share, row_key, seed).alias(c))
    for c, values in modalities.items():
        own = share / 2 if c in missing else share
        value = randomised_response(c, values, own, row_key, seed)
        out.append(with_gaps(value, c, missing, share, row_key, seed).alias(c))
    return df.select(*out)


def with_gaps(
    value: Column, column: str, missing: Sequence[str], share: float, row_key: str, seed: int
) -> Column:
    """NULL where the reported flag of a column in ``missing`` says so; the flag is true to the data with
    probability e^(share / 2) / (e^(share / 2) + 1)."""
    if column not in missing:
        return value
    keep = exp(share / 2) / (exp(share / 2) + 1)
    honest = uniform(seed, f"gap:{column}", col(row_key)) < F.lit(keep)
    return F.when(col(column).isNull() == honest, F.lit(None)).otherwise(value)


def clip(value: Column, low: float, high: float) -> Column:
    """Within the bounds; NULL stays NULL."""
    inside = F.least(F.greatest(value.cast("double"), F.lit(float(low))), F.lit(float(high)))
    return F.when(value.isNotNull(), inside)


def grid_of(scale: float) -> float:
    """Power of two, about a millionth of ``scale``: the step of noise and of the values it is added to."""
    return 2.0 ** (floor(log2(scale)) - 20)


def noisy_means(
    df: DataFrame, bounds: Mapping[str, tuple[float, float]], budget: float, seed: int
) -> dict[str, float]:
    """Quotients of noisy sums and noisy counts, within the bounds; one aggregate pass.

    One row changes a sum by at most upper - lower and a count by at most 1.
    """
    if not bounds:
        return {}
    share = budget / len(bounds) / 2
    aggs, out = [], []
    for i, (c, (low, high)) in enumerate(bounds.items()):
        grid, middle = grid_of((high - low) / share), (low + high) / 2
        steps = F.round((clip(col(c), low, high) - F.lit(middle)) / F.lit(grid)).cast("decimal(38,0)")
        aggs += [F.coalesce(F.sum(steps), F.lit(0)).cast("double").alias(f"s{i}"), F.count(col(c)).alias(f"n{i}")]
        total = F.col(f"s{i}") * F.lit(grid) + discrete_laplace(
            (high - low + grid) / share, grid, seed, f"sum:{c}", F.lit(c))
        count = F.greatest(F.col(f"n{i}") + discrete_laplace(1 / share, 1.0, seed, f"count:{c}", F.lit(c)), F.lit(1.0))
        out.append(clip(F.lit(middle) + total / count, low, high).alias(c))
    return df.agg(*aggs).select(*out).first().asDict()


def budget_ledger(
    *, epsilon: float, bounds: Mapping[str, tuple[float, float]], modalities: Mapping[str, Sequence[str]],
    preprocess_budget_ratio: float = 0.5, missing: Sequence[str] = (),
) -> list[tuple[str, str, float]]:
    """(column, step, epsilon) of everything ``private_rows`` with these settings spends on a row."""
    out = []
    for c in bounds:
        each = epsilon * preprocess_budget_ratio / len(bounds) / 2
        out += [(c, "sum", each), (c, "count", each)]
    share = (1 - preprocess_budget_ratio) * epsilon / max(1, len(bounds) + len(modalities))
    for c in [*bounds, *modalities]:
        if c in missing:
            out += [(c, "gap", share / 2), (c, "value", share / 2)]
        else:
            out.append((c, "value", share))
    return out


def randomised_response(
    column: str, values: Sequence[str], budget: float, row_key: str, seed: int
) -> Column:
    """Keep the value or move to one of the others; nulls and unlisted values are always replaced."""
    m = len(values)
    if m < 2:
        return F.lit(values[0]) if values else F.lit(None).cast("string")
    keep = exp(budget) / (exp(budget) + m - 1)
    listed = F.array(*[F.lit(v) for v in values])
    place = F.coalesce(F.array_position(listed, col(column).cast("string")), F.lit(0)).cast("int")
    stays = (uniform(seed, f"keep:{column}", col(row_key)) < F.lit(keep)) & (place > 0)
    jump = F.floor(uniform(seed, f"jump:{column}", col(row_key)) * (m - 1)).cast("int") + 1
    known = F.pmod(place - 1 + jump, F.lit(m)) + 1
    fresh = F.floor(uniform(seed, f"jump:{column}", col(row_key)) * m).cast("int") + 1
    moved = F.element_at(listed, F.when(place > 0, known).otherwise(fresh).cast("int"))
    return F.when(stays, col(column).cast("string")).otherwise(moved)
