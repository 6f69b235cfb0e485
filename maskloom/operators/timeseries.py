"""Series of individuals: alignment, projection, joint synthesis and rebuilding."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import sqrt

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskloom.functions.sizing import broadcast_if_small, lookup
from maskloom.functions.uniform import uniform
from maskloom.functions.validation import col, is_time
from maskloom.operators.processors.datetime import from_seconds, to_seconds
from maskloom.operators.scan import MAX_GROUP_ROWS, scan
from maskloom.session import materialize

# Names of the alignment methods and projections.
SPECIFIED, MAX, MIN, MEAN = "specified", "max", "min", "mean"
ALIGNMENTS = (SPECIFIED, MAX, MIN, MEAN)
FLATTEN, FPCA = "flatten", "fpca"
PROJECTIONS = (FLATTEN, FPCA)

#: Extra vectors and passes of the range finder.
OVERSAMPLE, PASSES = 8, 8


def common_length(
    df: DataFrame, id_variable: str, method: str, nb_points: int | None = None
) -> int:
    """Number of points all series are brought to."""
    if method not in ALIGNMENTS:
        raise ValueError(f"Expected an alignment among {ALIGNMENTS}, got {method!r} instead")
    if method == SPECIFIED:
        if not nb_points or nb_points < 1:
            raise ValueError("Expected nb_points with the 'specified' alignment")
        return nb_points
    sizes = df.groupBy(col(id_variable)).count()
    row = sizes.agg(F.max("count").alias(MAX), F.min("count").alias(MIN),
                    F.avg("count").alias(MEAN)).first()
    return int(row[method] + 0.5) if method == MEAN else int(row[method])


def align(
    df: DataFrame,
    id_variable: str,
    time_variable: str,
    values: Sequence[str],
    row_key: str,
    *,
    method: str = MAX,
    nb_points: int | None = None,
    carried: Sequence[str] = (),
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """(id, point, time, values, carried): every series at the same number of even times.

    ``carried`` columns, of any type, keep the value of the record that ends the segment of a point.

    Times are doubles (seconds for timestamps); values are interpolated linearly. Each record emits
    the grid points between its predecessor and itself, so there is one ordered pass and no join. What is
    written is a row per record; points are made from it whenever they are read.
    """
    n = common_length(df, id_variable, method, nb_points)
    field = df.schema[time_variable]
    time = to_seconds(time_variable, field.dataType) if is_time(field) else col(time_variable)
    rows = df.where(col(time_variable).isNotNull()).select(
        col(id_variable), time.cast("double").alias("__t"), col(row_key).alias("__k"),
        *[col(c).cast("double").alias(f"__v{i}") for i, c in enumerate(values)],
        *[col(c).alias(f"__c{i}") for i, c in enumerate(carried)],
    )
    ordered = scan(
        rows, [id_variable], ["__t", "__k"],
        lag={"__pt": "__t", **{f"__p{i}": f"__v{i}" for i in range(len(values))}},
        total={"__lo": ("min", "__t"), "__hi": ("max", "__t")},
        ordinal="__at", size="__n", max_group_rows=max_group_rows,
    )
    step = (F.col("__hi") - F.col("__lo")) / F.lit(float(max(n - 1, 1)))

    def grid(t):
        return F.coalesce(F.ceil(F.try_divide(t - F.col("__lo"), step)), F.lit(0)).cast("int")

    # both ends use the same expression, so neighbouring segments neither overlap nor leave gaps
    begin = F.when(F.col("__pt").isNull(), F.lit(0)).otherwise(grid(F.col("__pt")))
    end = F.when(F.col("__at") == F.col("__n"), F.lit(n)).when(
        F.col("__pt").isNull(), F.lit(0)).otherwise(F.least(grid(F.col("__t")), F.lit(n)))
    spans = materialize(ordered.withColumns({"__b": begin, "__e": end, "__step": step}).where("__e > __b"))
    points = spans.withColumn("point", F.explode(F.sequence(F.col("__b"), F.col("__e") - 1)))
    at = F.col("__lo") + F.col("point") * F.col("__step")
    share = F.least(F.coalesce(
        F.try_divide(at - F.col("__pt"), F.col("__t") - F.col("__pt")), F.lit(1.0)), F.lit(1.0))
    outs = []
    for i, c in enumerate(values):
        before = F.coalesce(F.col(f"__p{i}"), F.col(f"__v{i}"))
        outs.append((before + share * (F.col(f"__v{i}") - before)).alias(c))
    outs += [F.col(f"__c{i}").alias(c) for i, c in enumerate(carried)]
    return points.select(col(id_variable), "point", at.alias(time_variable), *outs)


def point_weight(points: int, projection: str) -> Column:
    """``fpca`` weighs each point by the square root of its share of the time axis (trapezoid rule), so that
    plain components become discretised functional components."""
    if projection not in PROJECTIONS:
        raise ValueError(f"Expected a projection among {PROJECTIONS}, got {projection!r} instead")
    if projection != FPCA or points < 2:
        return F.lit(1.0)
    inner = sqrt(1.0 / (points - 1))
    edge = (F.col("point") == 0) | (F.col("point") == points - 1)
    return F.when(edge, F.lit(inner / sqrt(2.0))).otherwise(F.lit(inner))


def series_vectors(
    aligned: DataFrame, id_variable: str, values: Sequence[str], points: int, projection: str
) -> DataFrame:
    """(id, features): one array of points x variables per series, for distances between whole series."""
    factor = point_weight(points, projection)
    cell = F.struct("point", F.array(*[col(c) * factor for c in values]).alias("v"))
    packed = aligned.groupBy(col(id_variable)).agg(F.array_sort(F.collect_list(cell)).alias("x"))
    return packed.select(col(id_variable), F.flatten(F.col("x.v")).alias("features"))


@dataclass(frozen=True)
class SeriesComponents:
    """Components of series: ``loadings`` (point, w), w holding for each variable one number per component."""

    values: tuple[str, ...]
    points: int
    projection: str
    loadings: DataFrame
    explained: np.ndarray

    def place(self, aligned: DataFrame, id_variable: str) -> DataFrame:
        """(id, features): scores of every series, not centred."""
        rows = _long(aligned, id_variable, self.values, self.points, self.projection)
        k = len(self.explained)
        return _scores(rows, self.loadings, len(self.values), k).select(
            F.col("id").alias(id_variable), F.col("y").alias("features"))


def _long(aligned: DataFrame, id_variable: str, values: Sequence[str], points: int, projection: str) -> DataFrame:
    factor = point_weight(points, projection)
    return aligned.select(col(id_variable).alias("id"), "point", F.array(*[col(c) * factor for c in values]).alias("x"))


def _scores(rows: DataFrame, loadings: DataFrame, width: int, k: int) -> DataFrame:
    """(id, y): each series times the loadings; summed per id ahead of the shuffle."""
    both = rows.join(broadcast_if_small(loadings), "point")
    sums = [F.sum(sum((F.col("x")[i] * F.col("w")[i * k + j] for i in range(1, width)), F.col("x")[0] * F.col("w")[j]))
            .alias(f"s{j}") for j in range(k)]
    return both.groupBy("id").agg(*sums).select("id", F.array(*[F.col(f"s{j}") for j in range(k)]).alias("y"))


def _small_gram(table: DataFrame, name: str, blocks: int, k: int) -> np.ndarray:
    """Sum over the rows, and over the ``blocks`` parts of their array, of outer products of k numbers."""
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = table.agg(*[F.sum(sum((F.col(name)[b * k + i] * F.col(name)[b * k + j] for b in range(1, blocks)),
                                F.col(name)[i] * F.col(name)[j])).alias(f"g{i}_{j}") for i, j in pairs]).first()
    out = np.zeros((k, k))
    for i, j in pairs:
        out[i, j] = out[j, i] = row[f"g{i}_{j}"] or 0.0
    return out


def _turned(name: str, blocks: int, matrix: np.ndarray) -> Column:
    """Each part of the array times a small matrix."""
    k = len(matrix)
    return F.array(*[
        sum((F.col(name)[b * k + i] * float(matrix[i, j]) for i in range(1, k)), F.col(name)[b * k] * float(matrix[0, j]))
        for b in range(blocks) for j in range(matrix.shape[1])])


def fit_series_components(
    aligned: DataFrame, id_variable: str, values: Sequence[str], points: int, *, projection: str = FPCA,
    nf: int = 3, passes: int = PASSES, seed: int = 0,
) -> SeriesComponents:
    """Components of the matrix with a row per series and a column per point and variable, kept as a long table.

    Block power iteration: scores are a join with the loadings of points and a sum per series, loadings are a
    join with the scores and a sum per point. No series is packed into a vector and no matrix of points by
    points exists, so their number is not limited. ``aligned`` is read in every pass and not written again; it is
    to come from :func:`align` or from a table. Signs: the largest loading of a component is positive (the
    first of equals).
    """
    values = tuple(values)
    width, columns = len(values), points * len(values)
    k = min(nf, columns)
    m = min(k + OVERSAMPLE, columns)
    rows = _long(aligned, id_variable, values, points, projection)
    n = rows.select("id").distinct().count()
    grid = aligned.sparkSession.range(points).select(F.col("id").cast("int").alias("point"))
    draw = [uniform(seed, f"series{i}", "point") - 0.5 for i in range(width * m)]
    loadings, last = materialize(grid.withColumn("w", F.array(*draw))), None
    for turn in range(passes + 1):
        size, axes = np.linalg.eigh(_small_gram(loadings, "w", width, m))
        good = np.where(size > 1e-14 * size.max(initial=1e-300), size, np.inf)
        loadings = materialize(loadings.withColumn("w", _turned("w", width, axes / np.sqrt(good))))
        scores = _scores(rows, loadings, width, m)
        centre = materialize(scores)
        means = centre.agg(*[F.avg(F.col("y")[j]).alias(f"m{j}") for j in range(m)]).first()
        mean = F.array(*[F.lit(means[f"m{j}"] or 0.0) for j in range(m)])
        centred = centre.withColumn("y", F.zip_with("y", mean, lambda a, b: a - b))
        spread, axes = np.linalg.eigh(_small_gram(centred, "y", 1, m) / n)
        settled = last is not None and np.abs(spread[-k:] - last).max() <= 1e-12 * spread[-1]
        if turn == passes or m == columns or settled:
            break
        last = spread[-k:]
        # the mean of the scores is 0, so columns need no centring here
        sums = [F.sum(F.col("x")[i] * F.col("y")[j]).alias(f"s{i}_{j}") for i in range(width) for j in range(m)]
        moved = lookup(rows, centred, "id").groupBy("point").agg(*sums)
        loadings = materialize(moved.select("point", F.array(*[
            F.col(f"s{i}_{j}") / F.lit(n) for i in range(width) for j in range(m)]).alias("w")))
    turned = loadings.withColumn("w", _turned("w", width, axes[:, ::-1][:, :k]))
    largest = turned.agg(*[F.max(F.greatest(*[F.abs(F.col("w")[i * k + j]) for i in range(width)], F.lit(0.0))).alias(f"a{j}")
                           for j in range(k)]).first()
    firsts = []
    for j in range(k):
        near = [F.when(F.abs(F.col("w")[i * k + j]) >= F.lit((1 - 1e-9) * largest[f"a{j}"]), F.struct(
            (F.col("point") * width + i).alias("at"), F.col("w")[i * k + j].alias("v"))) for i in range(width)]
        firsts.append(F.min(near[0] if width == 1 else F.least(*near)).alias(f"f{j}"))
    first = turned.agg(*firsts).first()
    signs = np.diag([1.0 if first[f"f{j}"]["v"] >= 0 else -1.0 for j in range(k)])
    loadings = materialize(turned.withColumn("w", _turned("w", width, signs)))
    return SeriesComponents(values, points, projection, loadings, spread[::-1][:k])


def series_scores(
    aligned: DataFrame,
    id_variable: str,
    values: Sequence[str],
    points: int,
    *,
    projection: str = FPCA,
    nf: int = 3,
) -> tuple[DataFrame, SeriesComponents]:
    """(id, features = nf centred scores) and the fitted components."""
    components = fit_series_components(aligned, id_variable, values, points, projection=projection, nf=nf)
    scores = materialize(components.place(aligned, id_variable))
    names = [f"m{i}" for i in range(len(components.explained))]
    means = scores.agg(*[F.avg(F.col("features")[i]).alias(n) for i, n in enumerate(names)]).first()
    centre = F.array(*[F.lit(means[n]) for n in names])
    centred = F.zip_with("features", centre, lambda x, m: x - m)
    return scores.withColumn("features", centred), components


def attach_scores(
    individuals: DataFrame, key: str, scores: DataFrame, id_variable: str, nf: int,
    prefix: str = "score",
) -> DataFrame:
    """Individual rows with ``<prefix>_1..nf``; NULL for individuals without a series."""
    named = scores.select(
        col(id_variable).alias("__id"),
        *[F.col("features")[i].alias(f"{prefix}_{i + 1}") for i in range(nf)],
    )
    return individuals.join(named, col(key) == F.col("__id"), "left").drop("__id")


def weighted_series(
    weights: DataFrame, aligned: DataFrame, id_variable: str, columns: Sequence[str],
    carried: Sequence[str] = (),
) -> DataFrame:
    """(id, point, columns, carried): aligned series mixed with the neighbour weights of the individuals.

    ``columns`` include the time, which is mixed like any value; ``carried`` columns come from the
    heaviest neighbour.
    """
    donors = aligned.withColumnRenamed(id_variable, "neighbor_id")
    joined = lookup(weights, donors, "neighbor_id", how="inner")
    total = F.sum("weight")
    return joined.groupBy("query_id", "point").agg(
        *[(F.sum(F.col("weight") * col(c)) / total).alias(c) for c in columns],
        *[F.max_by(col(c), F.struct("weight", "neighbor_id")).alias(c) for c in carried],
    ).withColumnRenamed("query_id", id_variable)


def rebuild(
    series: DataFrame, id_variable: str, time_variable: str, source: DataFrame
) -> DataFrame:
    """Long table with the column types of ``source``; points become a row number per series."""
    outs = []
    for f in source.schema.fields:
        if f.name not in series.columns or f.name == id_variable:
            continue
        value = col(f.name)
        if is_time(f):
            value = from_seconds(value, f.dataType)
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            value = F.round(value).cast(f.dataType)
        else:
            value = value.cast(f.dataType)
        outs.append(value.alias(f.name))
    return series.select(col(id_variable), "point", *outs)
