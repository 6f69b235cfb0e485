"""Datetime columns as seconds since 1970 and back."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskloom.functions.validation import col, is_time

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def seconds_sql(name: str, data_type: T.DataType) -> str:
    """Double seconds since the epoch, microseconds kept."""
    quoted = "`" + name.replace("`", "``") + "`"
    if isinstance(data_type, T.TimestampType):
        return f"unix_micros({quoted}) / 1e6D"
    return f"timestampdiff(MICROSECOND, {EPOCH}, cast({quoted} as timestamp_ntz)) / 1e6D"


def to_seconds(name: str, data_type: T.DataType) -> Column:
    return F.expr(seconds_sql(name, data_type))


def from_seconds(seconds: Column, data_type: T.DataType) -> Column:
    micros = F.round(seconds * F.lit(1e6)).cast("bigint")
    if isinstance(data_type, T.TimestampType):
        return F.timestamp_micros(micros)
    return F.timestamp_add("MICROSECOND", micros, F.expr(EPOCH)).cast(data_type)


@dataclass(frozen=True)
class DatetimeProcessor:
    def fit(self, df: DataFrame) -> DatetimeProcessor:
        return self

    def preprocess(self, df: DataFrame) -> DataFrame:
        times = {f.name: to_seconds(f.name, f.dataType) for f in df.schema.fields if is_time(f)}
        return df.withColumns(times) if times else df

    def postprocess(self, source: DataFrame, dest: DataFrame) -> DataFrame:
        fields = [f for f in source.schema.fields if is_time(f) and f.name in dest.columns]
        times = {f.name: from_seconds(col(f.name).cast("double"), f.dataType) for f in fields}
        return dest.withColumns(times) if times else dest
