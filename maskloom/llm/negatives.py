"""Hard negatives by lists that all anchors of a cluster share.

Anchors are clustered by angle. For each cluster the candidates of a block are sorted once by an upper bound
of their inner product with any member: length times the cosine of the angle to the cluster's centre less the
cluster's widest angle. Every member walks that list with exact products until the bound times its own length
is under what it already has; then nothing further down can matter.

Candidates lie in blocks of one cell each, anchors in slices of neighbouring clusters. A slice meets the
blocks whose bound, from the angle between the two centres, reaches one of its thresholds; first thresholds
come from a sample of rows and only ever exclude what the sample already beats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from maskloom.functions.sizing import broadcast_if_small
from maskloom.llm.common import arrow_map, as_array, empty, need, schema_of
from maskloom.llm.vectors import common_length, exact_product, finite, matrix
from maskloom.session import materialize

SCALE = 256
#: Rows that fit the centres and give first thresholds.
SAMPLE = 4096
#: About the most candidates of a block, and anchors of a slice, that one task holds.
BLOCK_ROWS, SLICE_ROWS = 1 << 16, 1 << 14
#: Members that walk together, and candidates between two looks at the bound.
MEMBERS, STEP = 1024, 1024
#: What rounding can take from a cosine, and from a bound; scores are whole numbers.
SLACK, LEAST = 1e-7, 0.01
NONE = -(1 << 62)
OUT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def units(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths, and directions (a zero vector has none and stays zero)."""
    x = x.astype(np.float64)
    norm = np.sqrt((x * x).sum(axis=1))
    return norm, x / np.where(norm > 0, norm, 1)[:, None]


def centres_of(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from evenly spaced rows; a centre without rows stays where it was."""
    _, x = units(x)
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)]
    for _ in range(rounds):
        cell = (x @ centres.T).argmax(axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, cell, x)
        norm, moved = units(total)
        centres = np.where((norm > 1e-9)[:, None], moved, centres)
    return centres


def angles(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1, 1))


def best(owner: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int):
    """The first ``k`` of each owner by falling score, then rising id."""
    order = np.lexsort((ids, -scores, owner))
    owner, ids, scores = owner[order], ids[order], scores[order]
    first = np.searchsorted(owner, owner)
    keep = np.arange(len(owner)) - first < k
    return owner[keep], ids[keep], scores[keep]


def walk(members, candidates, order, bounds, k: int, found):
    """Let members walk a shared list.

    ``members``: dict of ``v, label, id, norm`` and per slot ``low, high, floor``; a slot wants its best ``k``
    candidates with scores from ``low`` to ``high``, ``floor`` being known to be reached by ``k`` of them.
    ``found``: (slot, id, score) arrays so far, owner ``member * slots + slot``.
    """
    slots = members["low"].shape[1]
    need_ = np.maximum(members["low"], members["floor"])
    for start in range(0, len(order), STEP):
        reach = bounds[start] * members["norm"] + LEAST
        live = np.flatnonzero((reach[:, None] >= need_).any(axis=1))
        if not len(live):
            break
        chunk = order[start : start + STEP]
        scores = exact_product(members["v"][live], candidates["v"][chunk].T)
        same = members["label"][live][:, None] == candidates["label"][chunk][None, :]
        fit = (same if members["same"] else ~same) & (members["id"][live][:, None] != candidates["id"][chunk][None, :])
        new = []
        for s in range(slots):
            hit = fit & (scores >= need_[live, s][:, None]) & (scores <= members["high"][live, s][:, None])
            row, column = np.nonzero(hit)
            new.append((live[row] * slots + s, candidates["id"][chunk[column]], scores[row, column].astype(np.int64)))
        if not any(len(n[0]) for n in new):
            continue
        found = best(*(np.concatenate(x) for x in zip(found, *new)), k)
        owner, count = np.unique(found[0], return_counts=True)
        last = found[2][np.cumsum(count) - 1][count == k]
        full = owner[count == k]
        need_[full // slots, full % slots] = np.maximum(need_[full // slots, full % slots], last)
    return found


def nothing() -> tuple[np.ndarray, ...]:
    return tuple(np.zeros(0, np.int64) for _ in range(3))


def slots_of(batch, same: bool) -> dict:
    """Per anchor and slot: least and greatest wanted score."""
    n = len(batch["vec_id"])
    if same:
        return {"low": np.full((n, 1), NONE), "high": np.full((n, 1), -NONE), "scores": None, "ids": None}
    lists = batch["positives"].to_pylist()
    width = max((len(p) for p in lists), default=0) or 1
    low, high = np.full((n, width), -NONE), np.full((n, width), NONE)
    scores, ids = np.zeros((n, width), np.int64), np.zeros((n, width), np.int64)
    for i, positives in enumerate(lists):
        for s, p in enumerate(positives):
            if p["score"] >= 0:
                low[i, s], high[i, s] = -(-p["low"] * p["score"] // 100), p["high"] * p["score"] // 100
            scores[i, s], ids[i, s] = p["score"], p["id"]
    return {"low": low, "high": high, "scores": scores, "ids": ids}


def packed(cells: list[tuple[int, int]], rows: int) -> dict[int, tuple[int, int]]:
    """First number and pieces of each cell: small neighbours share a number, large cells have several."""
    out, number, filled = {}, 0, 0
    for cell, n in cells:
        pieces = -(-n // rows)
        if pieces > 1 or filled + n > rows:
            number, filled = number + (filled > 0), 0
        out[cell] = (number, max(1, pieces))
        if pieces > 1:
            number += pieces
        else:
            filled += n
    return out


def placed_by(table: dict[int, tuple[int, int]]) -> tuple[Column, Column]:
    """First number and number of pieces for the row's cell."""
    pairs = F.create_map(*[F.lit(x) for c, v in table.items() for x in (c, list(v))])
    return pairs[F.col("cell")][0], pairs[F.col("cell")][1]


def one_per_id(rows: DataFrame) -> DataFrame:
    """Of rows with one ``vec_id`` only the least (by label, then vector); vectors move only if there are any."""
    repeated = rows.groupBy("vec_id").count().where("count > 1")
    if not repeated.take(1):
        return rows
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")


class Search:
    """The rows of one call: centres, blocks of candidates, and what a slice of anchors finds in them."""

    def __init__(self, rows: DataFrame, anchor: Column, clusters: int, block_rows: int, slice_rows: int):
        spark, self.slice_rows = rows.sparkSession, slice_rows
        self.dimension = common_length(rows, "v")
        self.found_any = self.dimension > 0
        if not self.found_any:
            return
        dimension = self.dimension
        rows = one_per_id(rows.where(F.size("v") == dimension))
        sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
        drawn = {"v": matrix(sample["v"].combine_chunks(), dimension), "label": sample["label"].to_numpy(),
                 "id": sample["vec_id"].to_numpy()}
        centres = centres_of(drawn["v"], clusters)
        self.centres = centres
        self.shipped = shipped = spark.sparkContext.broadcast((drawn, centres))

        def place(batches: Iterator[dict]) -> Iterator[dict]:
            for batch in batches:
                norm, unit = units(matrix(batch["v"], dimension))
                cosine = unit @ shipped.value[1].T
                cell = cosine.argmax(axis=1)
                angle = angles(cosine[np.arange(len(cell)), cell])
                yield batch | {"cell": cell, "norm": norm, "angle": angle}

        placed = materialize(arrow_map(
            rows.select("vec_id", "label", "v", anchor.alias("anchor")), place,
            "vec_id long, label int, v array<long>, anchor boolean, cell int, norm double, angle double"))
        cells = placed.groupBy("cell").agg(
            F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("anchor"), 1)).alias("anchors"),
            F.max("norm").alias("norm"), F.max("angle").alias("angle")).orderBy("cell").collect()
        self.cells = [(r["cell"], -(-r["n"] // block_rows), r["norm"], r["angle"]) for r in cells]
        pieces = F.create_map(*[F.lit(x) for c, p, _, _ in self.cells for x in (c, p)])[F.col("cell")]
        # zero vectors can have any angle to a member: their bound is 0, as their length
        self.candidates = placed.select(
            "vec_id", "label", "v", "cell", F.pmod(F.xxhash64("vec_id"), pieces).cast("int").alias("piece"))
        first, parts = placed_by(packed([(r["cell"], r["anchors"]) for r in cells], slice_rows))
        self.anchors = placed.where("anchor").select(
            "vec_id", "label", "v", "cell", "norm", "angle",
            (first + F.pmod(F.xxhash64("vec_id"), parts)).cast("int").alias("slice"))

    def floors(self, anchors: DataFrame, same: bool, k: int) -> DataFrame:
        """``floors``: per slot a score that ``k`` rows of the sample reach, if so many do; ``need``: the least wanted."""
        dimension, shipped = self.dimension, self.shipped

        def work(batches: Iterator[dict]) -> Iterator[dict]:
            drawn = shipped.value[0]
            everything, no_bound = np.arange(len(drawn["id"])), np.full(len(drawn["id"]), np.inf)
            for batch in batches:
                v, out = matrix(batch["v"], dimension), slots_of(batch, same)
                floors = np.full(out["low"].shape, NONE)
                for a in range(0, len(v), MEMBERS):
                    part = slice(a, a + MEMBERS)
                    low = out["low"][part]
                    members = {"v": v[part], "label": batch["label"].to_numpy()[part], "same": same,
                               "id": batch["vec_id"].to_numpy()[part], "norm": np.ones(len(low)), "low": low,
                               "high": out["high"][part], "floor": np.full(low.shape, NONE)}
                    owner, _, scores = walk(members, drawn, everything, no_bound, k, nothing())
                    who, count = np.unique(owner, return_counts=True)
                    last = scores[np.cumsum(count) - 1]
                    full = who[count == k]
                    floors[a + full // low.shape[1], full % low.shape[1]] = last[count == k]
                need_ = np.maximum(floors, out["low"])
                yield batch | {"floors": floors.tolist(), "need": need_.min(axis=1)}

        return materialize(arrow_map(anchors, work, f"{ddl(anchors)}, floors array<long>, need long"))

    def visits(self, anchors: DataFrame) -> DataFrame:
        """(slice, cell, piece) where a bound reaches a threshold."""
        known = [(c, p, n, t, self.centres[c].tolist()) for c, p, n, t in self.cells]
        groups = anchors.groupBy("slice", "cell").agg(
            F.max("angle").alias("angle"), F.max("norm").alias("norm"), F.min("need").alias("need"))

        def work(batches: Iterator[dict]) -> Iterator[dict]:
            target = np.array([c[4] for c in known])
            far, wide = np.array([c[2] for c in known]), np.array([c[3] for c in known])
            for batch in batches:
                own = np.array([self_centres[c] for c in batch["cell"].to_pylist()]).reshape(-1, target.shape[1])
                gap = angles(own @ target.T) - batch["angle"].to_numpy()[:, None] - wide[None, :]
                reach = batch["norm"].to_numpy()[:, None] * far * (
                    np.maximum(np.cos(np.clip(gap, 0, np.pi)), 0) + SLACK)
                meet = reach + LEAST >= batch["need"].to_numpy()[:, None]
                rows = [(s, known[j][0], p) for s, m in zip(batch["slice"].to_pylist(), meet)
                        for j in np.flatnonzero(m) for p in range(known[j][1])]
                columns = list(zip(*rows)) or [[], [], []]
                yield dict(zip(("slice", "cell", "piece"), columns))

        self_centres = {c: self.centres[c].tolist() for c, *_ in self.cells}
        return materialize(arrow_map(groups, work, "slice int, cell int, piece int").distinct())

    def top(self, anchors: DataFrame, same: bool, k: int) -> DataFrame:
        """The best ``k`` of each anchor (``same``) or of each anchor and positive: ``anchor_id, slot, id, score``."""
        dimension, shipped, schema = self.dimension, self.shipped, "anchor_id long, slot int, id long, score long"
        target = to_arrow_schema(schema_of(schema))
        visits = self.visits(anchors)
        small = broadcast_if_small(visits)
        left = anchors.withColumnRenamed("cell", "own").join(small, "slice")
        right = self.candidates.join(small, ["cell", "piece"])

        def meet(left: pa.Table, right: pa.Table) -> pa.Table:
            left, right = left.combine_chunks(), right.combine_chunks()
            if not len(left) or not len(right):
                return target.empty_table()
            batch = {n: left[n].combine_chunks() for n in left.column_names}
            candidates = {"v": matrix(right["v"].combine_chunks(), dimension), "label": right["label"].to_numpy(),
                          "id": right["vec_id"].to_numpy()}
            length, unit = units(candidates["v"])
            v, slots = matrix(batch["v"], dimension), slots_of(batch, same)
            width = slots["low"].shape[1]
            floors = np.array([f + [NONE] * (width - len(f)) for f in (x[:width] for x in batch["floors"].to_pylist())])
            own, angle, norm = (batch[n].to_numpy() for n in ("own", "angle", "norm"))
            label, ids = batch["label"].to_numpy(), batch["vec_id"].to_numpy()
            out = []
            for cell in np.unique(own):
                of_cell = np.flatnonzero(own == cell)
                apart = angles(unit @ shipped.value[1][cell]) - angle[of_cell].max()
                bound = length * (np.maximum(np.cos(np.clip(apart, 0, np.pi)), 0) + SLACK)
                order = np.argsort(-bound, kind="stable")
                for a in range(0, len(of_cell), MEMBERS):
                    some = of_cell[a : a + MEMBERS]
                    members = {"v": v[some], "label": label[some], "id": ids[some], "norm": norm[some], "same": same,
                               "low": slots["low"][some], "high": slots["high"][some], "floor": floors[some]}
                    owner, found, scores = walk(members, candidates, order, bound[order], k, nothing())
                    out.append((ids[some[owner // width]], owner % width, found, scores))
            return pa.Table.from_arrays(
                [as_array(np.concatenate(x), f.type) for x, f in zip(zip(*out), target)], schema=target)

        keys = ["slice", "cell", "piece"]
        met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, schema)
        order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "id")
        return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def mine_negatives(
    vectors: DataFrame, *, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    clusters: int = 16, block_rows: int = BLOCK_ROWS, slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """For each anchor and each of its ``positives`` nearest rows of its label, ``negatives`` rows of other labels.

    ``vectors`` has ``vec_id``, ``label``, ``embedding``; other columns are ignored. Entries become
    floor(256 x); a score is the inner product of these, higher first, then smaller ``vec_id``. A negative
    scores from ``low`` to ``high`` per cent of the positive's score, so a positive below 0 has none. Rows
    with a null in ``vec_id`` or ``label``, or whose vector is null, empty or holds null or non-finite entries,
    take no part, nor do vectors of another length than most have. Of rows with one ``vec_id`` the least (by
    label, then vector) takes part. Nothing is dropped by size: copies, ties and hot labels are all searched.
    """
    rows = need(vectors, "vec_id", "label", "embedding").where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(F.col("embedding"))
    ).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), F.transform(
        "embedding", lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("long")).alias("v"))
    search = Search(rows, anchor, clusters, block_rows, slice_rows)
    if not search.found_any:
        return empty(vectors.sparkSession, OUT)
    anchors = search.floors(search.anchors, True, positives)
    nearest = search.top(anchors, True, positives)
    wanted = F.struct(F.col("rank").alias("rank"), F.col("id").alias("id"), F.col("score").alias("score"),
                      F.lit(low).alias("low"), F.lit(high).alias("high"))
    lists = nearest.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.array_sort(F.collect_list(wanted)).alias("positives"))
    anchors = search.floors(anchors.drop("floors", "need").join(lists, "vec_id"), False, negatives)
    found = search.top(anchors, False, negatives)
    asked = anchors.select(F.col("vec_id").alias("anchor_id"), "positives")
    return found.join(asked, "anchor_id").withColumn("p", F.col("positives")[F.col("slot")]).select(
        "anchor_id", F.col("p.id").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"))
