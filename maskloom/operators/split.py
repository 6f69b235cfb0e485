"""Rows that cover every modality, and the split into a training part and batches."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.functions.sizing import broadcast_if_small
from maskloom.functions.validation import col
from maskloom.operators.ordinal import hash_ordinal
from maskloom.operators.processors.messages import TOO_MUCH_VARIABILITY
from maskloom.session import materialize


def first_occurrence_keys(df: DataFrame, columns: Sequence[str], row_key: str) -> DataFrame:
    """Keys of the rows in which some column shows a value for the first time (in key order).

    The minimum key per (column, value) is combined on the map side; nulls count as a value.
    """
    pairs = F.array(*[
        F.struct(F.lit(c).alias("c"), col(c).cast("string").alias("v")) for c in columns
    ])
    exploded = df.select(col(row_key), F.explode(pairs).alias("p"))
    firsts = exploded.groupBy("p.c", "p.v").agg(F.min(col(row_key)).alias(row_key))
    return firsts.select(col(row_key)).distinct()


def first_occurrences(df: DataFrame, columns: Sequence[str], row_key: str) -> DataFrame:
    keys = materialize(first_occurrence_keys(df, columns, row_key))
    return df.join(broadcast_if_small(keys), row_key, "left_semi")


def batch_parts(
    df: DataFrame,
    columns: Sequence[str],
    row_key: str,
    *,
    row_limit: int,
    seed: int = 0,
    output: str = "part",
) -> DataFrame:
    """Append the part number: part 0 trains (it opens with one row per modality), the rest follow.

    ``ceil(n / row_limit)`` near-equal consecutive parts of: first occurrences, then the other rows
    in seeded random order.
    """
    n = df.count()
    parts = max(1, ceil(n / row_limit))
    keys = materialize(first_occurrence_keys(df, columns, row_key))
    if keys.count() > row_limit * 0.5:
        raise ValueError(TOO_MUCH_VARIABILITY)
    marked = df.join(
        broadcast_if_small(keys.withColumn("__first", F.lit(True))), row_key, "left"
    )
    placed = hash_ordinal(
        marked, row_key, seed=seed, stream="batch", output="__at",
        leading=F.coalesce("__first", F.lit(False)), rows=n,
    )
    size, larger = divmod(n, parts)
    border = larger * (size + 1)
    part = F.when(F.col("__at") < border, F.floor(F.col("__at") / (size + 1))).otherwise(
        larger + F.floor((F.col("__at") - border) / max(size, 1))
    )
    return placed.select(*map(col, df.columns), part.cast("int").alias(output))
