"""Prefix composition of affine maps inside groups.

A recurrence ``v <- a*v + b`` looks sequential, but affine maps compose associatively. Rows are cut
into blocks of :data:`BLOCK` consecutive ordinals, each block folds to one map, the block maps are
scanned the same way (one level per factor ``BLOCK``), and every block is then expanded on its own.
No array is longer than ``BLOCK``, however long the group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom.functions.validation import col

BLOCK = 128


def _fold(items: Column) -> Column:
    """One (a, b) for the composition of ``items`` in array order."""
    start = F.struct(F.lit(1.0).alias("a"), F.lit(0.0).alias("b"))
    return F.aggregate(
        items,
        start,
        lambda acc, x: F.struct(
            (x["a"] * acc["a"]).alias("a"), (x["a"] * acc["b"] + x["b"]).alias("b")
        ),
    )


def _blocks(df: DataFrame, by: Sequence[str], row: Column) -> DataFrame:
    """(by, __block, __items): rows of one block, sorted by ordinal, as an array."""
    items = F.array_sort(F.collect_list(row))
    return (
        df.withColumn("__block", F.floor(F.col("__i") / BLOCK).cast("bigint"))
        .groupBy(*map(col, by), "__block")
        .agg(items.alias("__items"))
    )


def _exclusive_maps(maps: DataFrame, by: Sequence[str], largest: int) -> DataFrame:
    """(by, __i, __pa, __pb): composition of all maps before ``__i`` in the group."""
    row = F.struct(F.col("__i").alias("i"), F.col("__a").alias("a"), F.col("__b").alias("b"))
    blocks = _blocks(maps, by, row)
    if largest <= BLOCK:
        lead = blocks.withColumns({"__ca": F.lit(1.0), "__cb": F.lit(0.0)})
    else:
        lead = _with_block_lead(blocks, by, largest)
    # running maps: every step appends the composition reached before the item
    start = F.struct(
        F.col("__ca").alias("a"),
        F.col("__cb").alias("b"),
        F.array().cast("array<struct<i:bigint,a:double,b:double>>").alias("seen"),
    )

    def step(acc, x):
        before = F.struct(x["i"].alias("i"), acc["a"].alias("a"), acc["b"].alias("b"))
        return F.struct(
            (x["a"] * acc["a"]).alias("a"),
            (x["a"] * acc["b"] + x["b"]).alias("b"),
            F.array_append(acc["seen"], before).alias("seen"),
        )

    seen = F.aggregate(F.col("__items"), start, step, lambda acc: acc["seen"])
    return lead.select(*map(col, by), F.explode(seen).alias("x")).select(
        *map(col, by), F.col("x.i").alias("__i"), F.col("x.a").alias("__pa"),
        F.col("x.b").alias("__pb"),
    )


def _with_block_lead(blocks: DataFrame, by: Sequence[str], largest: int) -> DataFrame:
    """Attach to each block the composition of all earlier blocks of its group."""
    folded = blocks.select(*map(col, by), F.col("__block").alias("__i"), _fold(F.col("__items"))
                           .alias("m"))
    maps = folded.select(*map(col, by), "__i", F.col("m.a").alias("__a"), F.col("m.b").alias("__b"))
    lead = _exclusive_maps(maps, by, -(-largest // BLOCK))
    lead = lead.select(*map(col, by), F.col("__i").alias("__block"), F.col("__pa").alias("__ca"),
                       F.col("__pb").alias("__cb"))
    return blocks.join(lead, [*by, "__block"], "inner")


def value_before(
    df: DataFrame,
    by: Sequence[str],
    *,
    ordinal: str,
    a: str,
    b: str,
    seed: str,
    largest: int,
    output: str,
) -> DataFrame:
    """Append ``output``: the value of the recurrence just before each row's own map is applied.

    ``ordinal`` counts from 1 inside the group, ``seed`` is the start value (equal on all rows of a
    group) and ``largest`` bounds the rows per group.
    """
    carried = [c for c in df.columns]
    row = F.struct(
        (col(ordinal) - 1).cast("bigint").alias("i"),
        col(a).alias("a"),
        col(b).alias("b"),
        col(seed).cast("double").alias("s"),
        F.struct(*[col(c).alias(f"c{n}") for n, c in enumerate(carried)]).alias("row"),
    )
    blocks = _blocks(df.withColumn("__i", (col(ordinal) - 1).cast("bigint")), by, row)
    if largest <= BLOCK:
        lead = blocks.withColumns({"__ca": F.lit(1.0), "__cb": F.lit(0.0)})
    else:
        lead = _with_block_lead(blocks, by, largest)
    opening = F.col("__ca") * F.element_at("__items", 1)["s"] + F.col("__cb")
    start = F.struct(opening.alias("v"), F.array().cast("array<double>").alias("seen"))

    def step(acc, x):
        return F.struct(
            (x["a"] * acc["v"] + x["b"]).alias("v"),
            F.array_append(acc["seen"], acc["v"]).alias("seen"),
        )

    seen = F.aggregate(F.col("__items"), start, step, lambda acc: acc["seen"])
    paired = F.arrays_zip(F.col("__items").alias("item"), seen.alias("before"))
    out = lead.select(F.explode(paired).alias("x"))
    return out.select(
        *[F.col("x.item")["row"][f"c{n}"].alias(c) for n, c in enumerate(carried)],
        F.col("x.before").alias(output),
    )
