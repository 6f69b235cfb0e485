"""Exact nearest neighbours and ball counts at scale, without comparing all pairs.

A two-level k-d tree: the top tree, learnt from a bounded sample and shipped to tasks, cuts the candidates
into partitions; a task builds a tree over the candidates of one partition. A query is bounded by a search
in its own partition (or by the smallest node above it with enough rows), then descends the top tree and
opens only nodes whose tight box touches its ball. Both passes run per (partition, query chunk, candidate
chunk), so no task ever holds more than a chunk of each side, however crowded a partition is. The result is
exact: a node is skipped only when its box is provably farther than the k-th neighbour already known.

Copies: of candidates with equal vectors only the k + 1 smallest keys can be among anyone's k
nearest (ties go to the smaller key), so the others are dropped before the search by a partial
top-(k + 1) that runs ahead of the shuffle. Ball counts weigh each distinct vector by its copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from maskloom.functions.validation import col
from maskloom.operators.tree import NARROW, PointTree, Splits, Tree, median_splits
from maskloom.session import materialize

PART_ROWS = 20_000
#: Leaves of the top tree that are shipped at most. Partitions of larger tables are searched in chunks.
TOP_LEAVES = 1 << 16
SAMPLE_PER_LEAF = 16
QUERY_CHUNK = 4_000
CANDIDATE_CHUNK = 2 * PART_ROWS
#: Numbers of one side of a block in many dimensions, where a row is compared with most others.
WIDE_VALUES = 4_000_000
WIDE_QUERIES = 1_000
#: Rows of a leaf of the tree within a task.
TREE_LEAF = 32


def fit_partition(candidates: DataFrame, vector: str, key: str, rows: int, part_rows: int | None = None) -> Splits:
    """Top tree: median splits learnt from a hash sample of bounded size, one leaf for ``part_rows`` rows."""
    depth = 0
    while (1 << depth) < TOP_LEAVES and rows / (1 << depth) > (part_rows or PART_ROWS):
        depth += 1
    if not depth:
        return median_splits(np.zeros((0, 1)), 0)
    wanted = SAMPLE_PER_LEAF << depth
    share = min(1.0, 1.2 * wanted / rows)
    chosen = F.pmod(F.xxhash64(col(key), F.lit(17)), F.lit(1_000_000)) < int(share * 1_000_000) + 1
    sample = candidates.where(chosen).select(vector).limit(2 * wanted).toArrow()[vector]
    return median_splits(_matrix(sample), depth if len(sample) else 0)


def _matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows x dimensions of a list column, without a Python object per row."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(vectors), -1)


def _values(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy()


def _with_leaf(df: DataFrame, vector: str, partition: Splits) -> DataFrame:
    if partition.depth == 0:
        return df.withColumn("leaf", F.lit(0).cast("long"))

    @F.arrow_udf("long")
    def leaf(points: pa.Array) -> pa.Array:
        return pa.array(partition.assign(_matrix(points)))

    return df.withColumn("leaf", leaf(F.col(vector)))


def _chunk(key: str, rows: F.Column | str, size: int):
    """(number of chunks of a leaf, chunk of this row) by hash; even whatever the data."""
    chunks = F.greatest(F.ceil(F.col(rows) / F.lit(size)), F.lit(1)).cast("int")
    return chunks, F.pmod(F.xxhash64(col(key), F.lit(29)), chunks).cast("int")


def _top_tree(candidates: DataFrame, splits: Splits, dims: int) -> Tree:
    """Tight boxes and row counts of the partitions, on the driver: as many as the top tree has leaves."""
    bounds = [F.min(F.col("vec")[d]) for d in range(dims)], [F.max(F.col("vec")[d]) for d in range(dims)]
    found = candidates.groupBy("leaf").agg(
        F.sum("weight").alias("weight"), F.array(*bounds[0]).alias("low"), F.array(*bounds[1]).alias("high")).toArrow()
    leaf = found["leaf"].to_numpy()
    low, high = np.zeros((2, splits.leaves, dims))
    weight = np.zeros(splits.leaves, dtype=np.int64)
    if len(leaf):
        low[leaf], high[leaf], weight[leaf] = _matrix(found["low"]), _matrix(found["high"]), found["weight"].to_numpy()
    return Tree(splits, low, high, weight)


def task_count(df: DataFrame, groups: int) -> int:
    """Partitions for CPU-bound groups.

    Given explicitly, because adaptive execution sizes partitions by bytes and would merge small but
    expensive groups into one task.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(max(groups, 1), max(cores, shuffle)))


def _chunk_rows(df: DataFrame, dims: int, visits: int) -> tuple[int, int]:
    """Rows of a query chunk and of a candidate chunk.

    In many dimensions nearly every query meets nearly every chunk, so rows would be copied as often as there are
    chunks; these are as large as a task can hold, while there are blocks for all tasks.
    """
    if dims <= NARROW:
        return QUERY_CHUNK, CANDIDATE_CHUNK
    most = max(1, WIDE_VALUES // dims)
    even = -(-visits // (4 * df.sparkSession.sparkContext.defaultParallelism))
    return min(most, max(WIDE_QUERIES, even)), 2 * most


def _part_rows(dims: int) -> int:
    return PART_ROWS if dims <= NARROW else max(PART_ROWS, WIDE_VALUES // dims)


def _block_pairs(visits: DataFrame, candidates: DataFrame, dims: int, *more: str):
    """Both sides keyed by (leaf, query chunk, candidate chunk), ready for a cogroup.

    A row of either side is repeated once per chunk of the other side in its leaf.
    """
    leaf_rows = candidates.groupBy("leaf").agg(F.count(F.lit(1)).alias("leaf_rows"))
    visit_rows = visits.groupBy("leaf").agg(F.count(F.lit(1)).alias("visit_rows"))
    # a row per leaf of the top tree, which is bounded
    sizes = materialize(visit_rows.join(leaf_rows, "leaf", "inner"))
    asked = sizes.agg(F.sum("visit_rows")).first()[0] or 0
    query_rows, candidate_rows = _chunk_rows(visits, dims, asked)
    q_chunks, q_chunk = _chunk("qid", "visit_rows", query_rows)
    c_chunks, c_chunk = _chunk("cid", "leaf_rows", candidate_rows)
    left = visits.join(F.broadcast(sizes), "leaf", "inner").withColumns(
        {"qc": q_chunk, "cc": F.explode(F.sequence(F.lit(0), c_chunks - 1))}
    )
    right = candidates.join(F.broadcast(sizes), "leaf", "inner").withColumns(
        {"cc": c_chunk, "qc": F.explode(F.sequence(F.lit(0), q_chunks - 1))}
    )
    keys = ["leaf", "qc", "cc"]
    blocks = sizes.agg(F.sum(q_chunks * c_chunks)).first()[0] or 1
    tasks = task_count(visits, blocks)
    right = right.select(*keys, "cid", "vec", "weight", *more)
    return left.repartition(tasks, *keys).groupBy(*keys), right.repartition(tasks, *keys).groupBy(*keys)


def _prepare(df: DataFrame, key: str, vector: str, name: str) -> DataFrame:
    return df.select(col(key).alias(name), col(vector).cast("array<double>").alias("vec"))


def nearest(
    queries: DataFrame,
    candidates: DataFrame,
    k: int,
    *,
    query_key: str,
    candidate_key: str,
    query_vector: str = "features",
    candidate_vector: str = "features",
    exclude_self: bool = False,
    part_rows: int | None = None,
) -> DataFrame:
    """(query_id, neighbor_id, distance, rank): the ``k`` nearest candidates of every query.

    Ties go to the smaller key. ``exclude_self`` drops the candidate with the query's own key. A null entry
    of a query's vector is not measured: its distances run over its other entries. Candidates have no nulls.
    A partition of the top tree holds about ``part_rows`` candidates (default ``PART_ROWS``).
    Fails when there are fewer than ``k`` candidates to choose from.
    """
    queries = _prepare(queries, query_key, query_vector, "qid")
    candidates = _prepare(candidates, candidate_key, candidate_vector, "cid")
    total, dims = _shape(candidates)
    if k < 1 or total - int(exclude_self) < k:
        raise ValueError(f"Expected k between 1 and {total - int(exclude_self)}, got {k} instead")
    schema = T.StructType([
        T.StructField("query_id", queries.schema["qid"].dataType),
        T.StructField("neighbor_id", candidates.schema["cid"].dataType),
        T.StructField("d2", T.DoubleType()), T.StructField("rank", T.IntegerType()),
    ])
    out_type = to_arrow_schema(schema)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        return _top(left, right, k, exclude_self, out_type)

    keep = k + int(exclude_self)
    splits = fit_partition(candidates, "vec", "cid", total, part_rows or _part_rows(dims))
    useful = _with_leaf(candidates, "vec", splits)
    if splits.depth:
        same = Window.partitionBy("leaf", "vec").orderBy("cid")
        # a rank limit runs as a partial limit before the shuffle, so copies never travel in bulk
        useful = useful.withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= keep)
    useful = materialize(
        useful.select("cid", "vec", "leaf", F.lit(1).cast("bigint").alias("weight"))
    )
    if splits.depth:
        tree = _top_tree(useful, splits, dims)
        visits = _visits(materialize(_with_leaf(queries, "vec", splits)), useful, tree, k, exclude_self, dims)
    else:
        visits = queries.withColumns({"r2": F.lit(float("inf")), "leaf": F.lit(0).cast("long")})
    left, right = _block_pairs(visits, useful, dims)
    found = left.cogroup(right).applyInArrow(search, schema)
    best = Window.partitionBy("query_id").orderBy("d2", "neighbor_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return _with_distance(ranked)


def _with_distance(found: DataFrame) -> DataFrame:
    return found.select("query_id", "neighbor_id", F.sqrt("d2").alias("distance"), "rank")


def _shape(df: DataFrame) -> tuple[int, int]:
    """(rows, dimensions) in one pass."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("d")).first()
    return int(row["n"]), int(row["d"] or 0)


def _top(
    left: pa.Table, right: pa.Table, k: int, exclude_self: bool, schema: pa.Schema
) -> pa.Table:
    """The k nearest of ``right`` for each row of ``left``; ties by key, kept exactly."""
    if not left.num_rows or not right.num_rows:
        return schema.empty_table()
    right = right.sort_by("cid")
    tree = PointTree(_matrix(right["vec"]), max(TREE_LEAF, k + 1))
    own = _own(left, right) if exclude_self else None
    rows, cols, dist = tree.nearest(_matrix(left["vec"]), _values(left, "r2"), k, own)
    rank = np.arange(len(rows)) - np.searchsorted(rows, rows) + 1
    return pa.table(
        [left["qid"].take(pa.array(rows)), right["cid"].take(pa.array(cols)), pa.array(dist),
         pa.array(rank.astype("int32"))],
        schema=schema,
    )


def _own(left: pa.Table, right: pa.Table) -> np.ndarray:
    """Row of ``right`` that has the query's own key, or -1."""
    place = pc.index_in(left["qid"].combine_chunks(), value_set=right["cid"].combine_chunks())
    return place.fill_null(-1).to_numpy(zero_copy_only=False)


def _visits(
    placed: DataFrame, useful: DataFrame, tree: Tree, k: int, exclude_self: bool, dims: int
) -> DataFrame:
    """(qid, vec, r2, leaf) for every partition that may hold one of the k nearest.

    ``r2`` bounds the squared distance of the k-th neighbour: by a search in the query's own partition, or,
    where that has too few rows, by the smallest node above it that has enough.
    """
    schema = T.StructType([
        placed.schema["qid"],
        T.StructField("vec", T.ArrayType(T.DoubleType())),
        T.StructField("r2", T.DoubleType()),
        T.StructField("leaves", T.ArrayType(T.LongType())),
    ])
    out_type = to_arrow_schema(schema)
    shipped = placed.sparkSession.sparkContext.broadcast(tree)
    need = k + int(exclude_self)

    def bound(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return out_type.empty_table()
        points = _matrix(left["vec"])
        radius = shipped.value.radius(points, need)
        if right.num_rows >= need:
            own = _own(left, right) if exclude_self else None
            rows, _, dist = PointTree(_matrix(right["vec"]), max(TREE_LEAF, k + 1)).nearest(points, radius, k, own)
            last, count = np.unique(rows, return_counts=True)
            full = count == k
            at = np.cumsum(count)[full] - 1
            radius[last[full]] = np.minimum(radius[last[full]], dist[at])
        rows, leaves = shipped.value.visit(points, radius)
        ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(points)))])
        lists = pa.ListArray.from_arrays(pa.array(ends.astype("int32")), pa.array(leaves[np.argsort(rows, kind="stable")]))
        return pa.table([left["qid"], left["vec"], pa.array(radius), lists], schema=out_type)

    # the first chunk of the own partition is enough for a valid radius
    sizes = useful.groupBy("leaf").agg(F.count(F.lit(1)).alias("leaf_rows"))
    counts = placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("visit_rows"))
    sizes = F.broadcast(materialize(counts.join(sizes, "leaf", "left").fillna(0, ["leaf_rows"])))
    asked = sizes.agg(F.sum("visit_rows")).first()[0] or 0
    query_rows, candidate_rows = _chunk_rows(placed, dims, asked)
    _, chunk = _chunk("cid", "leaf_rows", candidate_rows)
    q_chunks, q_chunk = _chunk("qid", "visit_rows", query_rows)
    left = placed.join(sizes, "leaf").withColumn("qc", q_chunk)
    right = useful.join(sizes, "leaf").where(chunk == 0).withColumn(
        "qc", F.explode(F.sequence(F.lit(0), q_chunks - 1))
    ).select("leaf", "qc", "cid", "vec")
    tasks = task_count(placed, max(4 * tree.leaves, sizes.agg(F.sum(q_chunks)).first()[0] or 0))
    left, right = (x.repartition(tasks, "leaf", "qc").groupBy("leaf", "qc") for x in (left, right))
    bounded = materialize(left.cogroup(right).applyInArrow(bound, schema))
    # a vector is written once, whatever the number of partitions it visits
    return bounded.select("qid", "vec", "r2", F.explode("leaves").alias("leaf"))


def count_within(
    queries: DataFrame,
    candidates: DataFrame,
    *,
    query_key: str,
    candidate_key: str,
    radius: str,
    query_vector: str = "features",
    candidate_vector: str = "features",
) -> DataFrame:
    """(query_id, n): candidates strictly nearer than the query's own squared ``radius`` column.

    The top tree is descended from its root: a node wholly inside the ball adds its row count, a node outside
    adds nothing; only partitions cut by the sphere are joined, and searched by a tree of their own. Null
    entries of a query are not measured.
    """
    queries = queries.select(
        col(query_key).alias("qid"), col(query_vector).cast("array<double>").alias("vec"),
        col(radius).cast("double").alias("r2"),
    )
    candidates = _prepare(candidates, candidate_key, candidate_vector, "cid")
    total, dims = _shape(candidates)
    splits = fit_partition(candidates, "vec", "cid", total, _part_rows(dims))
    distinct = _with_leaf(candidates, "vec", splits).groupBy("leaf", "vec").agg(
        F.min("cid").alias("cid"), F.count(F.lit(1)).alias("weight")
    )
    distinct = materialize(distinct)
    tree = queries.sparkSession.sparkContext.broadcast(_top_tree(distinct, splits, dims))
    schema = T.StructType([
        queries.schema["qid"], T.StructField("vec", T.ArrayType(T.DoubleType())),
        T.StructField("r2", T.DoubleType()), T.StructField("inside", T.LongType()),
        T.StructField("leaves", T.ArrayType(T.LongType())),
    ])

    split_type = to_arrow_schema(schema)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _matrix(batch["vec"])
            rows, leaves, inside = tree.value.count(points, batch["r2"].to_numpy())
            ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(points)))])
            order = np.argsort(rows, kind="stable")
            lists = pa.ListArray.from_arrays(pa.array(ends.astype("int32")), pa.array(leaves[order]))
            yield pa.RecordBatch.from_arrays(
                [batch["qid"], batch["vec"], batch["r2"], pa.array(inside), lists], schema=split_type)

    parted = materialize(queries.mapInArrow(split, schema))
    cut = parted.select("qid", "vec", "r2", F.explode("leaves").alias("leaf"))
    out_schema = T.StructType([queries.schema["qid"], T.StructField("n", T.LongType())])
    count_type = to_arrow_schema(out_schema)

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return count_type.empty_table()
        points = _matrix(right["vec"])
        n = PointTree(points, TREE_LEAF).weight_within(
            _matrix(left["vec"]), _values(left, "r2"), _values(right, "weight"))
        return pa.table([left["qid"], pa.array(n)], schema=count_type)

    left, right = _block_pairs(cut, distinct, dims)
    compared = left.cogroup(right).applyInArrow(count, out_schema)
    known = parted.select("qid", F.col("inside").alias("n"))
    both = known.unionByName(compared).groupBy("qid").agg(F.sum("n").alias("n"))
    return both.select(F.col("qid").alias("query_id"), "n")


def least_priced(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """(query_id, neighbor_id, value): for each query the least distance plus price, ties to the smaller id.

    ``queries`` has ``id, features, limit`` (a value that some candidate reaches), ``candidates`` has
    ``id, features, price``. Nodes of the top tree are opened where their box and least price can reach a limit.
    """
    queries = queries.select(F.col("id").alias("qid"), F.col("features").cast("array<double>").alias("vec"),
                             F.col("limit").cast("double").alias("u"))
    candidates = candidates.select(F.col("id").alias("cid"), F.col("features").cast("array<double>").alias("vec"),
                                   F.col("price").cast("double").alias("price"))
    total, dims = _shape(candidates)
    splits = fit_partition(candidates, "vec", "cid", total, _part_rows(dims))
    held = materialize(_with_leaf(candidates, "vec", splits).withColumn("weight", F.lit(1).cast("long")))
    least = held.agg(F.min("price")).first()[0] or 0.0
    reach = F.greatest(F.col("u") - F.lit(least), F.lit(0.0))
    # a little wider than the limit, as its square is rounded
    asked = queries.withColumn("r2", reach * reach * (1 + 1e-9) + 1e-12)
    schema = T.StructType([
        T.StructField("query_id", queries.schema["qid"].dataType),
        T.StructField("neighbor_id", candidates.schema["cid"].dataType), T.StructField("value", T.DoubleType()),
    ])
    out_type = to_arrow_schema(schema)
    tree = queries.sparkSession.sparkContext.broadcast(_top_tree(held, splits, dims))

    @F.arrow_udf("array<long>")
    def touched(points: pa.Array, r2: pa.Array) -> pa.Array:
        rows, leaves = tree.value.visit(_matrix(points), r2.to_numpy(zero_copy_only=False))
        order = np.argsort(rows, kind="stable")
        ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(points)))])
        return pa.ListArray.from_arrays(pa.array(ends.astype("int32")), pa.array(leaves[order].astype("int64")))

    # a vector is written once, whatever the number of partitions it visits
    visits = materialize(asked.withColumn("leaves", touched("vec", "r2"))).select("qid", "vec", "u", F.explode("leaves").alias("leaf"))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return out_type.empty_table()
        right = right.sort_by("cid")
        rows, cols, value = PointTree(_matrix(right["vec"]), TREE_LEAF).least_priced(
            _matrix(left["vec"]), _values(left, "u"), _values(right, "price"))
        return pa.table([left["qid"].take(pa.array(rows)), right["cid"].take(pa.array(cols)), pa.array(value)],
                        schema=out_type)

    left, right = _block_pairs(visits, held, dims, "price")
    found = left.cogroup(right).applyInArrow(search, schema)
    first = F.min(F.struct("value", "neighbor_id")).alias("m")
    return found.groupBy("query_id").agg(first).select("query_id", "m.neighbor_id", "m.value")
