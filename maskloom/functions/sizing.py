"""Joins with tables whose size and key counts are checked first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskloom.functions.validation import col
from maskloom.session import materialize

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
HOT_ROWS = 1_000_000
SALT = "__salt"


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: lengths of texts and lists, 8 for each other value."""
    total = F.lit(0).cast("bigint")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = F.octet_length(col(f.name))
        elif isinstance(f.dataType, T.ArrayType):
            size = 16 * F.size(col(f.name))
        elif isinstance(f.dataType, (T.StructType, T.MapType)):
            size = F.octet_length(F.to_json(col(f.name)))
        else:
            size = F.lit(8)
        total = total + F.coalesce(size, F.lit(0)) + 8
    return total


def is_small(df: DataFrame, max_rows: int | None = None) -> bool:
    """At most ``max_rows`` rows of ``BROADCAST_BYTES`` in all; reads no more than one row beyond."""
    max_rows = BROADCAST_ROWS if max_rows is None else max_rows
    head = df.select(row_bytes(df).alias("b")).limit(max_rows + 1)
    row = head.agg(F.count(F.lit(1)).alias("n"), F.sum("b").alias("b")).first()
    return row["n"] <= max_rows and (row["b"] or 0) <= BROADCAST_BYTES


def broadcast_if_small(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Hint a broadcast when ``df`` is small in rows and bytes, else leave the join to Spark.

    Without the hint the join shuffles both sides and adaptive execution splits skewed partitions.
    """
    return F.broadcast(df) if is_small(df, max_rows) else df


def hot_keys(df: DataFrame, key: str, hot_rows: int | None = None) -> DataFrame:
    """(key, pieces) of the keys with more than ``hot_rows`` rows, a piece having so many at most.

    Only the key column is read and counts are combined before the shuffle.
    """
    limit = HOT_ROWS if hot_rows is None else hot_rows
    counts = df.where(col(key).isNotNull()).groupBy(col(key)).count()
    return counts.where(F.col("count") > limit).select(
        col(key), F.ceil(F.col("count") / F.lit(limit)).cast("int").alias("__pieces")
    )


def lookup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    *,
    how: str = "left",
) -> DataFrame:
    """Join ``left`` with a table of few rows per ``key``.

    A small ``right`` is broadcast. Otherwise both sides are shuffled; the rows of a hot key of ``left``
    are dealt to as many salts as it has pieces and its rows of ``right`` are copied to each, so a key
    with a third of all rows never lands in one task. There are at most rows / ``HOT_ROWS`` hot keys;
    they stay a table.
    """
    if is_small(right):
        return left.join(F.broadcast(right), key, how)
    hot = materialize(hot_keys(left, key))
    if not hot.take(1):
        return left.join(right, key, how)
    hot = broadcast_if_small(hot)
    pieces = F.coalesce(F.col("__pieces"), F.lit(1))
    # the task's number, not a random one: a task that runs again deals its rows alike
    dealt = left.withColumn("__task", F.spark_partition_id()).join(hot, key, "left")
    place = F.pmod(F.xxhash64(F.col("__task"), *[col(c) for c in left.columns]), pieces).cast("int")
    copies = right.join(hot, key, "left").withColumn(
        SALT, F.explode(F.sequence(F.lit(0), pieces - 1))).drop("__pieces")
    joined = dealt.withColumn(SALT, place).drop("__task", "__pieces").join(copies, [key, SALT], how)
    return joined.drop(SALT)
