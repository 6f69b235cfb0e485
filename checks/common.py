"""Shared pieces of the query suite and its SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


class Suite:
    """Queries and SQL strings under one name each."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(query: Query) -> Query:
            self.queries[name] = query
            if sql is not None:
                self.sql[name] = sql
            return query

        return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def r(value: Column | str, places: int = 6) -> Column:
    """Rounded double without negative zero."""
    value = (F.col(value) if isinstance(value, str) else value).cast("double")
    rounded = F.round(value, places)
    return F.when(F.abs(rounded) == 0, F.lit(0.0)).otherwise(rounded)


def sr(expr: str, places: int = 6) -> str:
    """SQL twin of :func:`r`."""
    rounded = f"round(cast({expr} as double), {places})"
    return f"(case when abs({rounded}) = 0 then cast(0 as double) else {rounded} end)"


def su(seed: int, stream: str, *keys: str) -> str:
    """SQL twin of ``uniform``."""
    parts = ", ".join(["'" + str(seed) + "'", f"'{stream}'"] + [f"cast({k} as varchar)" for k in keys])
    return f"(concat('0x', substr(md5(concat_ws('|', {parts})), 1, 8))::UBIGINT / 4294967296.0)"


def sfine(seed: int, stream: str, *keys: str) -> str:
    """SQL twin of ``fine``."""
    parts = ", ".join(["'" + str(seed) + "'", f"'{stream}'"] + [f"cast({k} as varchar)" for k in keys])
    text = f"md5(concat_ws('|', {parts}))"
    high, low = (f"concat('0x', substr({text}, {a}, {n}))::UBIGINT::BIGINT" for a, n in ((1, 8), (9, 6)))
    return f"(({high} * 2097152 + ({low} >> 3))::double / 9007199254740992.0)"


def micros(name: str) -> Column:
    """Microseconds since 1970 of a timestamp without time zone, whatever the session's zone."""
    return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col(name))
