"""Types and profiles of a table (one job per question, whatever the number of columns)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskloom.functions.validation import FLOATS, INTEGERS, NUMBERS, TIMES, col

NUMERIC, INT, BOOL, DATETIME, DATETIME_TZ, CATEGORY = (
    "numeric", "int", "bool", "datetime", "datetime_tz", "category",
)
LOGICAL_TYPES = (NUMERIC, INT, BOOL, DATETIME, DATETIME_TZ, CATEGORY)


def logical_type(data_type: T.DataType) -> str:
    if isinstance(data_type, (*FLOATS, T.DecimalType)):
        return NUMERIC
    if isinstance(data_type, INTEGERS):
        return INT
    if isinstance(data_type, T.BooleanType):
        return BOOL
    if isinstance(data_type, T.TimestampType):
        return DATETIME_TZ
    if isinstance(data_type, TIMES):
        return DATETIME
    return CATEGORY


def infer_types(df: DataFrame, overrides: Mapping[str, str] | None = None) -> dict[str, str]:
    """Logical type per column; ``overrides`` win. Reads the schema only."""
    overrides = dict(overrides or {})
    unknown = sorted(set(overrides.values()) - set(LOGICAL_TYPES))
    if unknown:
        raise ValueError(f"Expected logical types among {LOGICAL_TYPES}, got {unknown} instead")
    return {f.name: overrides.get(f.name, logical_type(f.dataType)) for f in df.schema.fields}


def split_columns_types(df: DataFrame) -> tuple[list[int], list[int]]:
    """Positions of continuous and of categorical columns; booleans and times are categorical."""
    continuous = [i for i, f in enumerate(df.schema.fields) if isinstance(f.dataType, NUMBERS)]
    categorical = [i for i in range(len(df.columns)) if i not in continuous]
    return continuous, categorical


def categorical_columns(df: DataFrame) -> list[str]:
    return [df.columns[i] for i in split_columns_types(df)[1]]


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_unique) with nulls not counted.

    Two levels of grouping: (column, value) pairs collapse on the map side, then pairs are counted.
    A ``count(distinct)`` over several columns would replicate every row once per column as well,
    but would funnel the final count of all columns through one task.
    """
    pairs = modality_counts(df, columns)
    counted = pairs.groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"))
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return names.join(counted, "column", "left").select(
        "column", F.coalesce("n_unique", F.lit(0)).cast("bigint").alias("n_unique")
    )


def _as_text(df: DataFrame, columns: Sequence[str]) -> Column:
    return F.array(*[
        F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in columns
    ])


def modality_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) for all ``columns`` in one job, nulls dropped; values as text."""
    pairs = df.select(F.explode(_as_text(df, columns)).alias("p")).select("p.column", "p.value")
    return pairs.where("value is not null").groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n")
    )


def numeric_under_threshold(df: DataFrame, *, threshold: int = 10) -> list[str]:
    """Non-categorical columns (times included) with at most ``threshold`` distinct values.

    An approximate count first rules out columns that are far above the threshold, so that only
    plausible ones are counted exactly.
    """
    fields = [f for f in df.schema.fields if isinstance(f.dataType, NUMBERS + TIMES)]
    names = [f.name for f in fields]
    if not names:
        return []
    rough = df.agg(*[F.approx_count_distinct(col(c)).alias(c) for c in names]).first().asDict()
    plausible = [c for c in names if rough[c] <= 2 * threshold + 50]
    if not plausible:
        return []
    # the sets are small by the check above, so one pass with map-side sets counts them exactly
    exact = df.agg(*[F.size(F.collect_set(col(c))).alias(c) for c in plausible]).first().asDict()
    return [c for c in plausible if exact[c] <= threshold]


def grouped_mean_std(
    df: DataFrame, targets: Sequence[str], by: Sequence[str] | None = None
) -> DataFrame:
    """Mean and sample standard deviation per group, null groups kept, as ``<col>mean/<col>std``."""
    aggs = []
    for c in targets:
        aggs += [F.avg(col(c)).alias(f"{c}mean"), F.stddev_samp(col(c)).alias(f"{c}std")]
    return df.groupBy(*map(col, by or [])).agg(*aggs)


def identifier_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_unique, n_present, n_rows, is_identifier) of the non-float columns.

    A column may be an identifier when every row has its own value.
    """
    fields = [f for f in df.schema.fields if not isinstance(f.dataType, (*FLOATS, T.DecimalType))]
    names = [f.name for f in fields if columns is None or f.name in columns]
    pairs = df.select(F.explode(_as_text(df, names)).alias("p")).select("p.column", "p.value")
    per_value = pairs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    present = F.col("value").isNotNull()
    out = per_value.groupBy("column").agg(
        F.count_if(present).alias("n_unique"),
        F.sum(F.when(present, F.col("n")).otherwise(0)).alias("n_present"),
        F.sum("n").alias("n_rows"),
    )
    same = (F.col("n_unique") == F.col("n_rows")) & (F.col("n_present") == F.col("n_rows"))
    return out.withColumn("is_identifier", same)
