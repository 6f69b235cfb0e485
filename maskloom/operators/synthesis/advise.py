"""Parameters suggested from the size and the modalities of a table."""

from __future__ import annotations

from math import sqrt

from pyspark.sql import DataFrame

from maskloom.functions.validation import is_number, is_time
from maskloom.operators.profile import distinct_counts
from maskloom.operators.synthesis.project import REDUCED_DIMS


def advise(df: DataFrame, row_key: str, table_name: str = "table") -> DataFrame:
    """(table_name, k, ncp, use_categorical_reduction) in one row.

    k = round(sqrt(n) / 2) within 5..50, ncp = min(5, encoded features), reduction when the
    categorical columns have more than 20 modalities together.
    """
    fields = [f for f in df.schema.fields if f.name != row_key]
    numbers = [f.name for f in fields if is_number(f) or is_time(f)]
    categories = [f.name for f in fields if f.name not in numbers]
    n = df.count()
    levels = 0
    if categories:
        levels = sum(r["n_unique"] for r in distinct_counts(df, categories).collect())
    k = max(5, min(50, int(sqrt(n) / 2 + 0.5)))
    row = (table_name, k, min(5, len(numbers) + levels), levels > REDUCED_DIMS)
    return df.sparkSession.createDataFrame(
        [row], "table_name string, k int, ncp int, use_categorical_reduction boolean"
    )
