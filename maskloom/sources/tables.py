"""Tables in and out: CSV with header, parquet, or a DataFrame passed as it is."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from maskloom.functions.validation import nan_to_null

CSV_SUFFIXES = (".csv", ".csv.gz", ".tsv")
PARQUET_SUFFIXES = (".parquet", ".pq")


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, **options: str
) -> DataFrame:
    """CSV with a header. Without ``schema`` the types are inferred, which costs one more pass."""
    reader = spark.read.option("header", True).options(**options)
    if schema is not None:
        return nan_to_null(reader.schema(schema).csv(path))
    return nan_to_null(reader.option("inferSchema", True).csv(path))


def read_table(
    spark: SparkSession, data: str | DataFrame, schema: T.StructType | str | None = None
) -> DataFrame:
    """A DataFrame stays lazy and untouched but for NaN; a path is read by its suffix."""
    if isinstance(data, DataFrame):
        return nan_to_null(data)
    path = data.rstrip("/").lower()
    if path.endswith(CSV_SUFFIXES):
        sep = {"sep": "\t"} if path.endswith(".tsv") else {}
        return read_csv(spark, data, schema, **sep)
    if path.endswith(PARQUET_SUFFIXES):
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return nan_to_null(reader.parquet(data))
    raise ValueError(f"Expected a .csv or .parquet path, got {data!r} instead")


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One CSV file per partition, each with a header; no row index."""
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)
