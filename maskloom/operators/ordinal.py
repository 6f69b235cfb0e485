"""A dense global position for every row without a single-partition sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskloom.functions.uniform import uniform
from maskloom.functions.validation import col
from maskloom.operators.scan import scan
from maskloom.session import materialize

BUCKET_ROWS = 500_000
MAX_BUCKETS = 65_536


def hash_ordinal(
    df: DataFrame,
    row_key: str,
    *,
    seed: int,
    stream: str,
    output: str,
    leading: Column | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Append ``output``: 0-based position in a seeded random order.

    Rows are bucketed by their hash, so buckets are even whatever the data. Only the bucket counts
    (at most ``MAX_BUCKETS``) pass through the driver; each bucket is numbered on its own.
    Rows with ``leading`` true come first, in key order: however many there are, they are numbered by ranges of
    keys and the counts of these, not in one task.
    """
    if leading is not None:
        marked = materialize(df.withColumn("__leading", F.coalesce(leading, F.lit(False))))
        ahead, rest = (marked.where(c).drop("__leading") for c in ("__leading", "not __leading"))
        m = ahead.count()
        placed = scan(ahead.withColumn("__all", F.lit(0)), ["__all"], [row_key], ordinal="__at",
                      max_group_rows=BUCKET_ROWS, sizes=(m, m))
        first = placed.select(*map(col, df.columns), (F.col("__at") - 1).cast("bigint").alias(output))
        others = hash_ordinal(rest, row_key, seed=seed, stream=stream, output=output)
        return first.unionByName(others.withColumn(output, col(output) + F.lit(m)))
    n = df.count() if rows is None else rows
    buckets = min(MAX_BUCKETS, max(8, n // BUCKET_ROWS))
    unit = uniform(seed, stream, col(row_key))
    bucket = F.floor(unit * buckets).cast("int")
    placed = df.withColumns({"__unit": unit, "__bucket": bucket})
    counts = placed.groupBy("__bucket").count().collect()
    offsets, seen = [], 0
    for row in sorted(counts, key=lambda x: x["__bucket"]):
        offsets.append((row["__bucket"], seen))
        seen += row["count"]
    table = df.sparkSession.createDataFrame(offsets, "__bucket int, __offset bigint")
    w = Window.partitionBy("__bucket").orderBy("__unit", col(row_key))
    numbered = placed.withColumn("__place", F.row_number().over(w) - 1)
    joined = numbered.join(F.broadcast(table), "__bucket", "inner")
    position = (F.col("__offset") + F.col("__place")).cast("bigint")
    return joined.select(*map(col, df.columns), position.alias(output))
