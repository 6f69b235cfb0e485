"""Privacy metrics: how far synthetic rows stay from the rows they came from.

All take row-aligned tables: a synthetic row carries the key of its source row. Coordinates are
(key, features) tables in the space of the originals. Every function returns one number; tables are
only ever searched by :func:`nearest` and :func:`count_within`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import combinations
from math import ceil, comb, inf, prod, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom.functions.sizing import is_small
from maskloom.functions.validation import col
from maskloom.operators.neighbors import count_within, nearest, task_count
from maskloom.operators.quantiles import exact_quantiles
from maskloom.operators.synthesis.project import fit_space
from maskloom.session import materialize

EARTH_RADIUS_KM = 6371.0088
#: About the seconds of a key of a row, of a pair that meets on a key, and of a value compared in a block. They only
#: choose the way.
KEY_COST, PAIR_COST, COMPARE_COST = 1e-5, 1e-6, 1e-10
#: Keys are worth this part of what the comparison of all would take.
KEYS_SHARE = 0.25
#: Choices of blocks that a row is keyed by at most.
MOST_KEYS = 64
#: Rows of either side of a block of comparisons at most.
COMPARED_ROWS = 50_000
#: Queries and rows of a tile of comparisons.
TILE = 32, 8_192
#: Values of a table's columns that are numbered for all tasks, and of a column whose numbers become bits.
NUMBERED_VALUES, BIT_VALUES = 2_000, 10
COMPARED = pa.schema([("q", pa.int64()), ("nearer", pa.int32()), ("ties", pa.int64())])


def squared_distance(a: Column, b: Column) -> Column:
    steps = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(steps, F.lit(0.0), lambda acc, x: acc + x)


def nearest_synthetic(originals: DataFrame, synthetic: DataFrame, key: str) -> DataFrame:
    return nearest(originals, synthetic, 1, query_key=key, candidate_key=key)


def hidden_rate(originals: DataFrame, synthetic: DataFrame, key: str) -> float:
    """100 x share of originals whose nearest synthetic row is not their own."""
    near = nearest_synthetic(originals, synthetic, key)
    other = (F.col("query_id") != F.col("neighbor_id")).cast("double")
    return near.agg((F.avg(other) * 100).alias("v")).first()["v"]


def hidden_individuals_rate(
    originals: DataFrame, synthetic: DataFrame, key: str, individuals: DataFrame
) -> float:
    """Hidden rate of individuals who own several rows: 100 x share of those of whom no row is nearest to a
    synthetic row made from a row of the same individual.

    ``individuals`` is (key, individual_id); rows without an individual are left out.
    """
    owner = individuals.where(F.col("individual_id").isNotNull())
    near = nearest_synthetic(originals, synthetic, key).select("query_id", "neighbor_id")
    own = near.join(owner.select(col(key).alias("query_id"), "individual_id"), "query_id")
    both = own.join(owner.select(col(key).alias("neighbor_id"), F.col("individual_id").alias("found")), "neighbor_id", "left")
    exposed = F.coalesce(F.col("individual_id") == F.col("found"), F.lit(False)).cast("int")
    each = both.groupBy("individual_id").agg(F.max(exposed).alias("exposed"))
    return each.agg((100 - 100 * F.avg("exposed")).alias("v")).first()["v"]


def cloaking_counts(originals: DataFrame, synthetic: DataFrame, key: str) -> DataFrame:
    """(query_id, n): synthetic rows strictly nearer to an original than its own synthetic row."""
    own = synthetic.select(col(key), F.col("features").alias("__own"))
    queries = originals.join(own, key, "inner").select(
        col(key), "features", squared_distance(F.col("features"), F.col("__own")).alias("r2")
    )
    return count_within(queries, synthetic, query_key=key, candidate_key=key, radius="r2")


def local_cloaking(originals: DataFrame, synthetic: DataFrame, key: str) -> float:
    """Median of :func:`cloaking_counts`."""
    return exact_quantiles(materialize(cloaking_counts(originals, synthetic, key)), "n", [0.5])[0]


def closest_distances(originals: DataFrame, synthetic: DataFrame, key: str) -> DataFrame:
    """(query_id, d1, ratio): distance to the closest original and d1 / d2 (1 when d2 = 0).

    Written once: quantiles read it several times.
    """
    near = nearest(synthetic, originals, 2, query_key=key, candidate_key=key)
    wide = near.groupBy("query_id").agg(
        F.max(F.when(F.col("rank") == 1, F.col("distance"))).alias("d1"),
        F.max(F.when(F.col("rank") == 2, F.col("distance"))).alias("d2"),
    )
    ratio = F.coalesce(F.try_divide("d1", "d2"), F.lit(1.0))
    return materialize(wide.select("query_id", "d1", ratio.alias("ratio")))


def distance_to_closest(closest: DataFrame) -> dict[str, float]:
    median, low = exact_quantiles(closest, "d1", [0.5, 0.05])
    return {"dcr_median": median, "dcr_p5": low}


def nearest_neighbor_ratio(closest: DataFrame) -> float:
    return exact_quantiles(closest, "ratio", [0.5])[0]


def closest_rate(
    originals: DataFrame,
    closest: DataFrame,
    key: str,
    *,
    percentage_threshold: float = 0.05,
    ratio_threshold: float = 0.5,
) -> float:
    """100 x share of synthetic rows that are both closer to an original than the
    ``percentage_threshold`` quantile of original-to-original distances and clearly closer to it
    than to the next one."""
    among = nearest(
        originals, originals, 1, query_key=key, candidate_key=key, exclude_self=True
    )
    limit = exact_quantiles(materialize(among.select("distance")), "distance",
                            [percentage_threshold])[0]
    risky = (F.col("d1") < F.lit(limit)) & (F.col("ratio") < F.lit(ratio_threshold))
    return closest.agg((F.avg(risky.cast("double")) * 100).alias("v")).first()["v"]


def column_direct_match(
    source: DataFrame, synthetic: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """(column, protection): 100 x share of rows whose value differs from the own source value."""
    own = source.select(col(key), *[col(c).alias(f"__o_{c}") for c in columns])
    joined = synthetic.join(own, key, "inner")
    aggs = [
        (100 - 100 * F.avg(col(c).eqNullSafe(col(f"__o_{c}")).cast("double"))).alias(f"p{i}")
        for i, c in enumerate(columns)
    ]
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"p{i}").alias("protection"))
             for i, c in enumerate(columns)]
    return joined.agg(*aggs).select(F.explode(F.array(*pairs)).alias("x")).select(
        "x.column", "x.protection"
    )


def column_direct_match_protection(source, synthetic, key, columns) -> float:
    table = column_direct_match(source, synthetic, key, columns)
    return table.agg(F.min("protection").alias("v")).first()["v"]


def row_direct_match_protection(
    source: DataFrame, synthetic: DataFrame, columns: Sequence[str]
) -> float:
    """100 x (1 - share of synthetic rows identical to some source row, nulls equal).

    Both tables are counted per distinct row in one grouping, so copies collapse before the shuffle.
    """
    both = source.select(*map(col, columns), F.lit(1).alias("__o"), F.lit(0).alias("__s")).unionAll(
        synthetic.select(*map(col, columns), F.lit(0).alias("__o"), F.lit(1).alias("__s"))
    )
    rows = both.groupBy(*map(col, columns)).agg(
        F.max("__o").alias("__o"), F.sum("__s").alias("__s")
    )
    matched = F.sum(F.when(F.col("__o") == 1, F.col("__s")).otherwise(0))
    return rows.agg((100 - 100 * matched / F.sum("__s")).alias("v")).first()["v"]


def categorical_hidden_rate(
    source: DataFrame, synthetic: DataFrame, key: str, columns: Sequence[str]
) -> float:
    """Hidden rate under Hamming distance on ``columns``; ties count fractionally.

    Two rows that differ in at most r columns agree on all but r of any number of blocks of columns, and meet on
    one choice of these. The radius grows from 0: rows that have found a synthetic row nearer than their own, or
    reached their own's distance, are done, so wide radii are left to few rows. Where so many rows would meet that
    it is less work to compare all, the rest is compared in blocks of both sides. Copies are counted rows.
    """
    m = len(columns)
    if not m:
        raise ValueError("Expected one column or more")

    def values(df: DataFrame) -> Column:
        # nulls equal each other; a prefix keeps them apart from any text
        return F.array(*[
            F.when(col(c).isNull(), "n").otherwise(F.concat(F.lit("v"), col(c).cast("string")))
            for c in columns
        ])

    theirs = materialize(synthetic.select(col(key), values(synthetic).alias("s")))
    counts = theirs.select(F.posexplode("s").alias("at", "v")).groupBy("at", "v").agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts)
    alike = _alike(counts, m)
    number = _numbered(counts, m)
    theirs = theirs.withColumn("s", number("s"))
    groups = materialize(theirs.groupBy("s").agg(F.count(F.lit(1)).alias("n")))
    apart = _apart()
    mine = _merged(source.select(col(key), values(source).alias("t")).withColumn("t", number("t")), theirs, key, "inner")
    mine = mine.groupBy("t", apart.alias("own")).agg(F.count(F.lit(1)).alias("weight"))
    left = materialize(mine.withColumn("q", F.monotonically_increasing_id()))
    hidden = total = spent = 0.0
    others = groups.count()
    for r in range(m):
        rows = left.count()
        if not rows:
            break
        blocks, cost = _blocking(r, alike, rows, others)
        whole = COMPARE_COST * m * rows * others
        spent += cost
        found = _by_blocks(left, groups, r, blocks, m, whole / PAIR_COST) if spent < KEYS_SHARE * whole else None
        compared = found is None
        if compared:
            found = _by_comparison(left, groups, m, rows, others)
        seen = materialize(_merged(left, found, "q", "left"))
        done = F.coalesce(F.col("nearer") == 1, F.lit(False)) | (F.col("own") == r) | F.lit(compared)
        rate = F.when(F.col("nearer") == 1, 1.0).otherwise(1 - 1 / F.col("ties"))
        row = seen.where(done).agg(F.sum(rate * F.col("weight")).alias("h"), F.sum("weight").alias("w")).first()
        hidden, total = hidden + (row["h"] or 0.0), total + (row["w"] or 0)
        left = materialize(seen.where(~done).select("t", "own", "weight", "q"))
    # what is left agrees with no synthetic row in any column: all of them are as far as its own
    row = left.agg(F.sum("weight").alias("w")).first()
    if row["w"]:
        every = groups.agg(F.sum("n")).first()[0]
        hidden, total = hidden + (1 - 1 / every) * row["w"], total + row["w"]
    return 100 * hidden / total if total else None


def _apart() -> Column:
    return F.size(F.filter(F.zip_with("t", "s", lambda a, b: a != b), lambda x: x))


def _merged(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str) -> DataFrame:
    """A join by shuffle. Lists of few values are small in a file and large in memory, so Spark, which goes by the file,
    would broadcast them."""
    return left.join(right.hint("merge"), on, how)


def _alike(counts: DataFrame, m: int) -> list[float]:
    """Chance that two rows agree, per column."""
    n = F.col("n").cast("double")
    found = counts.groupBy("at").agg((F.sum(n * n) / F.pow(F.sum(n), F.lit(2.0))).alias("p")).collect()
    chance = {row["at"]: row["p"] for row in found}
    return [chance.get(i, 1.0) for i in range(m)]


def _numbered(counts: DataFrame, m: int) -> Callable[[str], Column]:
    """Makes small numbers of the values ``v`` of column ``at``, 0 where no synthetic row has the value; where there
    are too many to be told to every task, values stay as they are."""
    if not is_small(counts, NUMBERED_VALUES):
        return F.col
    held = [[] for _ in range(m)]
    for row in counts.select("at", "v").orderBy("at", "v").collect():
        held[row["at"]].append(row["v"])
    kind = "tinyint" if max(map(len, held)) < 128 else "smallint"

    def number(name: str) -> Column:
        return F.array(*[F.array_position(F.array(*map(F.lit, own)), F.col(name)[i]).cast(kind) if own else F.lit(0).cast(kind)
                         for i, own in enumerate(held)])

    return number


def _edges(blocks: int, m: int) -> list[int]:
    return [b * m // blocks for b in range(blocks + 1)]


def _blocking(r: int, alike: Sequence[float], rows: int, others: int) -> tuple[int, float]:
    """(number of blocks, estimated seconds) of the cheapest way to find pairs that differ in ``r`` blocks at most."""
    best = None
    for blocks in range(r + 1, len(alike) + 1):
        if comb(blocks, r) > MOST_KEYS:
            break
        edge = _edges(blocks, len(alike))
        chance = [prod(alike[a:b]) for a, b in zip(edge, edge[1:])]
        meet = sum(prod(chance[i] for i in kept) for kept in combinations(range(blocks), blocks - r))
        cost = KEY_COST * comb(blocks, r) * (rows + others) + PAIR_COST * rows * others * meet
        if best is None or cost < best[1]:
            best = blocks, cost
    return best or (r + 1, inf)


def _by_blocks(left: DataFrame, groups: DataFrame, r: int, blocks: int, m: int, most: float) -> DataFrame | None:
    """(q, nearer, ties) of pairs that differ in ``r`` columns at most; None where more than ``most`` pairs meet."""
    edge = _edges(blocks, m)
    kept = list(combinations(range(blocks), blocks - r))

    def block(name: str, b: int) -> Column:
        return F.slice(name, edge[b] + 1, edge[b + 1] - edge[b])

    def keyed(df: DataFrame, name: str) -> DataFrame:
        keys = F.array(*[F.struct(F.lit(j).alias("b"), F.xxhash64(*[block(name, b) for b in one]).alias("h"))
                         for j, one in enumerate(kept)])
        return df.withColumn("x", F.explode(keys)).select(*df.columns, "x.b", "x.h")

    mine, theirs = keyed(left, "t"), keyed(groups, "s")
    meet = mine.groupBy("b", "h").agg(F.count(F.lit(1)).cast("double").alias("c"))
    meet = _merged(meet, theirs.groupBy("b", "h").agg(F.count(F.lit(1)).cast("double").alias("d")), ["b", "h"], "inner")
    if (meet.agg(F.sum(F.col("c") * F.col("d"))).first()[0] or 0.0) > most:
        return None
    # a pair that agrees on more blocks meets several times and counts at the first choice
    same = F.filter(F.array(*[F.when(block("t", b) == block("s", b), b) for b in range(blocks)]), lambda x: x.isNotNull())
    choices = F.array(*[F.array(*map(F.lit, one)) for one in kept])
    met = _merged(mine, theirs, ["b", "h"], "inner").withColumn("d", _apart()).where(F.col("d") <= F.least(F.lit(r), "own"))
    near = met.where(F.slice(same, 1, blocks - r) == choices[F.col("b")])
    return near.groupBy("q").agg(
        F.max((F.col("d") < F.col("own")).cast("int")).alias("nearer"),
        F.sum(F.when(F.col("d") == F.col("own"), F.col("n"))).alias("ties"))


def _by_comparison(left: DataFrame, groups: DataFrame, m: int, rows: int, others: int) -> DataFrame:
    """(q, nearer, ties) of all pairs, compared in blocks of both sides."""
    tasks = task_count(left, rows)
    size = min(COMPARED_ROWS, max(1_000, ceil(sqrt(rows * others / (4 * tasks)))))
    a, b = (max(1, ceil(x / size)) for x in (rows, others))
    mine = left.select(
        "q", "t", "own", F.pmod(F.xxhash64("q", F.lit(3)), F.lit(a)).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.lit(b - 1))).alias("j"))
    theirs = groups.select(
        "s", "n", F.explode(F.sequence(F.lit(0), F.lit(a - 1))).alias("i"), F.pmod(F.xxhash64("s", F.lit(5)), F.lit(b)).cast("int").alias("j"))

    def compare(x: pa.Table, y: pa.Table) -> pa.Table:
        if not x.num_rows or not y.num_rows:
            return COMPARED.empty_table()
        a, b = _codes(x["t"].combine_chunks(), y["s"].combine_chunks(), m)
        nearer, ties = _closest(a, b, x["own"].to_numpy(), y["n"].to_numpy())
        return pa.table([x["q"], pa.array(nearer), pa.array(ties)], schema=COMPARED)

    sides = (df.repartition(min(tasks, a * b), "i", "j").groupBy("i", "j") for df in (mine, theirs))
    found = next(sides).cogroup(next(sides)).applyInArrow(compare, "q bigint, nearer int, ties bigint")
    return found.groupBy("q").agg(F.max("nearer").alias("nearer"), F.nullif(F.sum("ties"), F.lit(0)).alias("ties"))


def _codes(a: pa.ListArray, b: pa.ListArray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """The values of both sides as numbers from 0, a row per column."""
    if pa.types.is_integer(a.type.value_type):
        return tuple(np.ascontiguousarray(x.flatten().to_numpy().reshape(-1, m).T) for x in (a, b))
    out = np.empty((m, len(a) + len(b)), dtype=np.int32)
    for i in range(m):
        parts = [x.flatten().take(pa.array(np.arange(i, len(x) * m, m))) for x in (a, b)]
        out[i] = pa.concat_arrays(parts).dictionary_encode().indices.to_numpy()
    return out[:, : len(a)], out[:, len(a) :]


def _closest(a: np.ndarray, b: np.ndarray, own: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per column of ``a``: 1 where a column of ``b`` has more equal entries than all but ``own``, and the summed ``n`` of
    those that have as many.

    Entries of few values become a bit each, so that a word of the processor compares several of them.
    """
    m, rows = a.shape
    words, wide, shift = [], [], 64
    for u, v in zip(a, b):
        size = max(int(u.max()), int(v.max())) + 1
        if size > BIT_VALUES:
            wide.append([x.astype(np.uint8 if size <= 256 else np.int32) for x in (u, v)])
            continue
        if shift + size > 64:
            words.append([np.zeros(len(x), dtype=np.uint64) for x in (u, v)])
            shift = 0
        for word, x in zip(words[-1], (u, v)):
            word |= np.uint64(1) << (x.astype(np.uint64) + np.uint64(shift))
        shift += size
    kind = np.uint8 if m < 256 else np.int32
    need = (m - own).astype(kind)
    nearer, ties = np.zeros(rows, dtype=np.int32), np.zeros(rows)
    for p in range(0, rows, TILE[0]):
        for q in range(0, b.shape[1], TILE[1]):
            x, y = slice(p, p + TILE[0]), slice(q, q + TILE[1])
            equal = np.zeros((len(need[x]), len(n[y])), dtype=kind)
            for u, v in words:
                equal += np.bitwise_count(u[x, None] & v[None, y])
            for u, v in wide:
                equal += u[x, None] == v[None, y]
            hit = np.flatnonzero(equal >= need[x, None])
            row, column = np.divmod(hit, equal.shape[1])
            more = equal.ravel()[hit] > need[p + row]
            nearer[p + row[more]] = 1
            ties[x] += np.bincount(row[~more], n[q + column[~more]], len(equal))
    return nearer, ties.astype(np.int64)


def nearest_by(
    source: DataFrame,
    synthetic: DataFrame,
    key: str,
    columns: Sequence[str],
    *,
    ncp: int | None = None,
) -> DataFrame:
    """(query_id, neighbor_id): nearest synthetic row by some columns, in their own space."""
    space = fit_space(source, columns, row_key=key, ncp=ncp)
    near = nearest_synthetic(space.place(source, key), space.place(synthetic, key), key)
    return near.select("query_id", "neighbor_id")


def correlation_protection_rate(
    source: DataFrame,
    synthetic: DataFrame,
    key: str,
    known: Sequence[str],
    others: Sequence[str],
    *,
    ncp: int | None = None,
) -> float:
    """100 x share of originals whose nearest synthetic row by the known variables differs from
    the nearest by the other ones."""
    a = nearest_by(source, synthetic, key, known, ncp=ncp)
    b = nearest_by(source, synthetic, key, others, ncp=ncp).withColumnRenamed("neighbor_id", "__b")
    differs = (F.col("neighbor_id") != F.col("__b")).cast("double")
    return a.join(b, "query_id").agg((F.avg(differs) * 100).alias("v")).first()["v"]


def inference(
    source: DataFrame,
    synthetic: DataFrame,
    key: str,
    known: Sequence[str],
    target: str,
    *,
    continuous: bool,
    tolerance: float = 0.1,
    ncp: int | None = None,
) -> float:
    """100 x share of originals whose ``target`` is guessed wrong from the nearest synthetic row by
    the known variables; numbers are wrong beyond a relative ``tolerance``."""
    near = nearest_by(source, synthetic, key, known, ncp=ncp)
    truth = source.select(col(key).alias("query_id"), col(target).alias("__true"))
    guess = synthetic.select(col(key).alias("neighbor_id"), col(target).alias("__guess"))
    joined = near.join(guess, "neighbor_id").join(truth, "query_id")
    true, guessed = F.col("__true"), F.col("__guess")
    if continuous:
        wrong = F.abs(guessed - true) > F.abs(true) * F.lit(tolerance)
    else:
        wrong = ~guessed.eqNullSafe(true)
    return joined.agg((F.avg(wrong.cast("double")) * 100).alias("v")).first()["v"]


def sphere_points(df: DataFrame, key: str, latitude: str, longitude: str) -> DataFrame:
    """(key, features) on the unit sphere: chord order is great-circle order."""
    lat, lon = F.radians(col(latitude)), F.radians(col(longitude))
    point = F.array(F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat))
    return df.select(col(key), point.alias("features"))


def great_circle_km(chord: Column) -> Column:
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.least(chord / 2, F.lit(1.0)))


def geolocation_privacy(
    source: DataFrame, synthetic: DataFrame, key: str, latitude: str, longitude: str
) -> dict[str, float]:
    """Hidden rate, local cloaking and distance to closest (km) by great-circle distance."""
    a = materialize(sphere_points(source, key, latitude, longitude))
    b = materialize(sphere_points(synthetic, key, latitude, longitude))
    near = nearest(b, a, 1, query_key=key, candidate_key=key)
    km = materialize(near.select(great_circle_km(F.col("distance")).alias("km")))
    return {
        "hidden_rate": hidden_rate(a, b, key),
        "local_cloaking": local_cloaking(a, b, key),
        "dcr_median": exact_quantiles(km, "km", [0.5])[0],
    }
