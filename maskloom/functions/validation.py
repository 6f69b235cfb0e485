"""Input checks that need at most one aggregate job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOATS = (T.FloatType, T.DoubleType)
INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
NUMBERS = FLOATS + INTEGERS + (T.DecimalType,)
TIMES = (T.TimestampNTZType, T.TimestampType, T.DateType)


def is_number(field: T.StructField) -> bool:
    return isinstance(field.dataType, NUMBERS)


def is_time(field: T.StructField) -> bool:
    return isinstance(field.dataType, TIMES)


def col(name: str) -> Column:
    """Column by exact name; names with dots need no escaping by the caller."""
    return F.col("`" + name.replace("`", "``") + "`")


def missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN in a floating column."""
    empty = col(name).isNull()
    return empty | F.isnan(col(name)) if isinstance(df.schema[name].dataType, FLOATS) else empty


def null_counts(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Nulls (and NaNs) per column in one pass over just those columns."""
    exprs = [F.count_if(missing(df, name)).alias(name) for name in dict.fromkeys(columns)]
    if not exprs:
        return {}
    return df.agg(*exprs).first().asDict()


def has_nulls(df: DataFrame, columns: Sequence[str]) -> bool:
    return any(null_counts(df, columns).values())


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating column; Spark aggregates treat NaN as a value."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, FLOATS)]
    return df.withColumns({c: F.nanvl(col(c), F.lit(None)) for c in floating}) if floating else df


def reject_minus_infinity(df: DataFrame) -> None:
    """Raise when a floating column holds -inf."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, FLOATS)]
    if not floating:
        return
    minus = F.lit(float("-inf"))
    found = df.agg(*[F.count_if(col(c) == minus).alias(c) for c in floating]).first().asDict()
    bad = sorted(c for c, n in found.items() if n)
    if bad:
        raise ValueError(f"Expected no -inf values, got columns {bad} with -inf instead")


def same_keys(left: DataFrame, right: DataFrame, key: str) -> bool:
    """True when both tables hold the same set of row keys."""
    return key_difference(left, right, key).limit(1).count() == 0


def key_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys found on one side only, labelled ``left`` or ``right``.

    One grouped pass over both key columns; the map side already collapses repeated keys.
    """
    both = left.select(col(key), F.lit(1).alias("in_left"), F.lit(0).alias("in_right")).unionAll(
        right.select(col(key), F.lit(0).alias("in_left"), F.lit(1).alias("in_right"))
    )
    sides = both.groupBy(col(key)).agg(F.max("in_left").alias("l"), F.max("in_right").alias("r"))
    side = F.when(F.col("l") == 1, "left").otherwise("right")
    return sides.where("l + r = 1").select(col(key), side.alias("side"))
