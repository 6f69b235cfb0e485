"""Linked tables: key checks, links between synthetic tables, and the views metrics run on."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.functions.sizing import lookup
from maskloom.functions.validation import col, is_number
from maskloom.operators.neighbors import nearest
from maskloom.session import materialize

# Names of the link methods.
LINEAR_SUM_ASSIGNMENT = "linear_sum_assignment"
MINIMUM_DISTANCE_ASSIGNMENT = "minimum_distance_assignment"
SENSITIVE_ORIGINAL_ORDER_ASSIGNMENT = "sensitive_original_order_assignment"
TIME_SERIES = "time_series"
LINK_METHODS = (
    LINEAR_SUM_ASSIGNMENT, MINIMUM_DISTANCE_ASSIGNMENT, SENSITIVE_ORIGINAL_ORDER_ASSIGNMENT,
    TIME_SERIES,
)


def primary_key_violations(df: DataFrame, table: str, key: str) -> DataFrame:
    """(rule, table_name, field, violations): nulls and repeated values of a primary key."""
    counts = df.groupBy(col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    row = counts.agg(
        F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count_if(F.col("k").isNotNull() & (F.col("n") > 1)).alias("repeated"),
    )
    rules = F.array(
        F.struct(F.lit("primary_key_null").alias("rule"), F.col("nulls").alias("violations")),
        F.struct(F.lit("primary_key_repeated").alias("rule"), F.col("repeated").alias("violations")),
    )
    return row.select(F.explode(rules).alias("x")).select(
        "x.rule", F.lit(table).alias("table_name"), F.lit(key).alias("field"),
        F.col("x.violations").cast("bigint").alias("violations"),
    )


def foreign_key_violations(
    child: DataFrame, child_table: str, child_field: str, parent: DataFrame, parent_field: str
) -> DataFrame:
    """Child rows whose non-null key has no parent. Keys are counted first, so a hot key is one row."""
    keys = child.where(col(child_field).isNotNull()).groupBy(col(child_field).alias("k")).agg(
        F.count(F.lit(1)).alias("n")
    )
    parents = parent.select(col(parent_field).alias("k"))
    lost = keys.join(parents, "k", "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("violations")
    )
    return lost.select(
        F.lit("foreign_key_unresolved").alias("rule"), F.lit(child_table).alias("table_name"),
        F.lit(child_field).alias("field"), "violations",
    )


def relink(
    synthetic_child: DataFrame,
    child_key: str,
    original_child: DataFrame,
    child_field: str,
    mapping: DataFrame | None = None,
) -> DataFrame:
    """Give each synthetic child a parent key.

    Without ``mapping`` it keeps the (row-aligned) synthetic twin of its original parent; with a
    (parent_id, synthetic_id) ``mapping`` it goes where its original parent is mapped.
    """
    own = original_child.select(col(child_key), col(child_field).alias("__parent"))
    rows = synthetic_child.drop(child_field).join(own, child_key, "left")
    if mapping is None:
        return rows.withColumnRenamed("__parent", child_field)
    target = materialize(mapping.select(
        F.col("parent_id").alias("__parent"), F.col("synthetic_id").alias(child_field)
    ))
    return lookup(rows, target, "__parent").drop("__parent")


def nearest_parents(originals: DataFrame, synthetic: DataFrame, key: str) -> DataFrame:
    """(parent_id, synthetic_id): nearest synthetic parent of each original; parents are reusable."""
    near = nearest(originals, synthetic, 1, query_key=key, candidate_key=key)
    return near.select(
        F.col("query_id").alias("parent_id"), F.col("neighbor_id").alias("synthetic_id")
    )


# -- views -------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Parent:
    """A parent table as seen from a child: its rows, its key and the child's field."""

    name: str
    data: DataFrame
    key: str
    child_field: str


def flatten(child: DataFrame, parents: Sequence[Parent]) -> DataFrame:
    """Child rows with all columns of all parents, prefixed by the parent's name."""
    out = child
    for parent in parents:
        named = parent.data.select(
            col(parent.key).alias(parent.child_field),
            *[col(c).alias(f"{parent.name}_{c}") for c in parent.data.columns if c != parent.key],
        )
        columns = [*out.columns, *[c for c in named.columns if c != parent.child_field]]
        out = lookup(out, named, parent.child_field).select(*map(col, columns))
    return out


def top_enriched(
    parent: DataFrame,
    key: str,
    children: Sequence[tuple[str, DataFrame, str, Sequence[str]]],
) -> DataFrame:
    """Parent rows with count, numeric means and categorical modes of each child table.

    ``children`` holds (name, rows, field, columns). All modes of a child come from one counting
    pass: (parent, column, value) counts collapse on the map side, then the most frequent value per
    column is picked (ties to the smallest).
    """
    out = parent
    for name, child, field, columns in children:
        numbers = [c for c in columns if is_number(child.schema[c])]
        categories = [c for c in columns if c not in numbers]
        means = child.groupBy(col(field).alias("__fk")).agg(
            F.count(F.lit(1)).alias(f"{name}_count"),
            *[F.avg(col(c)).alias(f"{name}_{c}_mean") for c in numbers],
        )
        out = out.join(means, col(key) == F.col("__fk"), "left").drop("__fk")
        out = out.withColumn(f"{name}_count", F.coalesce(f"{name}_count", F.lit(0)))
        if categories:
            cells = F.array(*[
                F.struct(F.lit(c).alias("c"), col(c).cast("string").alias("v")) for c in categories
            ])
            counts = (
                child.select(col(field).alias("__fk"), F.explode(cells).alias("x"))
                .where("x.v is not null")
                .groupBy("__fk", "x.c", "x.v").agg((-F.count(F.lit(1))).alias("n"))
            )
            picks = [
                F.min(F.when(F.col("c") == c, F.struct("n", "v")))["v"].alias(f"{name}_{c}_mode")
                for c in categories
            ]
            out = out.join(
                counts.groupBy("__fk").agg(*picks), col(key) == F.col("__fk"), "left"
            ).drop("__fk")
    return out


def bottom_id_propagated(child: DataFrame, field: str, output: str = "individual_id") -> DataFrame:
    """Child rows identified by their parent individual."""
    return child.withColumn(output, col(field))


def bottom_information_propagated(
    child: DataFrame, parent: Parent, output: str = "individual_id"
) -> DataFrame:
    return flatten(bottom_id_propagated(child, parent.child_field, output), [parent])


def full_enriched(
    child: DataFrame, reference: Parent, parents: Sequence[Parent], output: str = "individual_id"
) -> DataFrame:
    """Child rows with the columns of the other parents, identified by the reference parent."""
    others = [p for p in parents if p.name != reference.name]
    return flatten(bottom_id_propagated(child, reference.child_field, output), others)


def meta_metrics(metrics: DataFrame) -> DataFrame:
    """(metric, lowest, highest, mean) over tables, computation types and references."""
    return metrics.groupBy("metric").agg(
        F.min("value").alias("lowest"), F.max("value").alias("highest"),
        F.avg("value").alias("mean"),
    )
