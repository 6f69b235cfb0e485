"""The paths taken only on large or skewed data, forced on small fixtures, against brute force."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from maskloom.functions import sizing
from maskloom.operators import affine, comoments, neighbors, ordinal, quantiles, tree
from maskloom.operators.metrics import privacy
from maskloom.operators.processors import (
    InterRecordBoundedCumulatedDifferenceProcessor,
    InterRecordBoundedRangeDifferenceProcessor,
    InterRecordCumulatedDifferenceProcessor,
)
from maskloom.operators.scan import scan


@pytest.fixture
def hot(make):
    """A third of the rows in one group, with many equal order values."""
    rng = random.Random(5)
    n = 600
    ids = [0 if rng.random() < 0.34 else rng.randrange(1, 60) for _ in range(n)]
    return make("g bigint, o bigint, v double", g=ids, o=[rng.randrange(8) for _ in range(n)],
                v=[round(rng.uniform(-5, 5), 3) for _ in range(n)])


def test_scan_split_equals_plain(hot):
    wanted = dict(
        first={"f": "v"}, lag={"l": "v", "lo": "o"}, cumsum={"c": "v"},
        total={"t": ("sum", "v"), "m": ("max", "o")}, ordinal="at", size="n",
    )
    plain = rows_of(scan(hot, ["g"], ["o", "k"], **wanted))
    split = rows_of(scan(hot, ["g"], ["o", "k"], max_group_rows=25, **wanted))
    for name in plain:
        if name in ("c", "t"):
            assert split[name] == pytest.approx(plain[name], abs=1e-9)
        else:
            assert split[name] == plain[name]


def test_scan_split_with_null_group(make):
    df = make("g string, v bigint", g=[None] * 50 + ["a"] * 7, v=list(range(57)))
    out = rows_of(scan(df, ["g"], ["k"], cumsum={"c": "v"}, ordinal="at", max_group_rows=10))
    assert out["c"][49] == sum(range(50)) and out["at"][49] == 50 and out["at"][56] == 7


def test_cumulated_processor_on_a_hot_individual(hot):
    df = hot.select("k", F.col("g").alias("id"), F.col("v").alias("value"))
    model = InterRecordCumulatedDifferenceProcessor(
        "id", "value", "first", "diff", "k", keep_record_order=True, max_group_rows=30
    )
    back = rows_of(model.postprocess(df, model.preprocess(df)))
    assert back["value"] == pytest.approx(rows_of(df)["value"])


def decode(rows, lower, upper, changes):
    """Sequential decoding of (id, order, seed, change...) rows."""
    value, out = {}, {}
    for ident, order, seed, *steps in sorted(rows):
        v = value.get(ident, seed)
        seen = []
        for d in steps:
            v = v + d * abs(v - (upper if d >= 0 else lower))
            seen.append(v)
        value[ident], out[order] = v, seen
    return out


@pytest.mark.parametrize("block, hot_rows", [(128, 10**6), (4, 10**6), (3, 40)])
@pytest.mark.parametrize("wild", [False, True])
def test_bounded_decoding(make, monkeypatch, block, hot_rows, wild):
    monkeypatch.setattr(affine, "BLOCK", block)
    rng = random.Random(block + wild)
    n = 400
    ids = [0 if rng.random() < 0.4 else rng.randrange(1, 12) for _ in range(n)]
    # wild individuals leave the bounds: seed outside, or changes beyond 1
    diff = [rng.uniform(-1.6, 1.6) if wild and i % 3 == 1 else rng.choice([-1.0, 1.0, 0.0, rng.uniform(-1, 1)])
            for i in ids]
    seed = [25.0 if wild and i % 4 == 2 else 3.0 + i % 5 for i in ids]
    dest = make("id bigint, first double, diff double", id=ids, first=seed, diff=diff)
    source = make("id bigint, value double", id=[1, 1], value=[1.0, 9.0])
    model = InterRecordBoundedCumulatedDifferenceProcessor(
        "id", "value", "first", "diff", "k", max_group_rows=hot_rows
    ).fit(source)
    want = decode(list(zip(ids, range(n), seed, diff)), 1.0, 9.0, 1)
    got = rows_of(model.postprocess(source, dest))["value"]
    assert got == pytest.approx([want[i][0] for i in range(n)], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("block", [128, 4])
def test_bounded_range_decoding(make, monkeypatch, block):
    monkeypatch.setattr(affine, "BLOCK", block)
    rng = random.Random(block)
    n = 300
    ids = [rng.randrange(5) for _ in range(n)]
    gap = [rng.uniform(-1, 1) for _ in range(n)]
    length = [rng.choice([-1.0, 0.0, rng.uniform(-1, 1)]) for _ in range(n)]
    first = [2.0 + i for i in ids]
    dest = make("id bigint, first double, gap double, length double", id=ids, first=first, gap=gap, length=length)
    source = make("id bigint, s double, e double", id=[1], s=[1.0], e=[9.0])
    model = InterRecordBoundedRangeDifferenceProcessor(
        "id", "s", "e", "first", "length", "gap", "k", should_round_output=False
    ).fit(source)
    want = decode(list(zip(ids, range(n), first, gap, length)), 1.0, 9.0, 2)
    got = rows_of(model.postprocess(source, dest))
    assert got["s"] == pytest.approx([want[i][0] for i in range(n)], abs=1e-9)
    assert got["e"] == pytest.approx([want[i][1] for i in range(n)], abs=1e-9)


# -- neighbours --------------------------------------------------------------------------------

def cloud(spark, n, dims, seed, copies=0.34):
    """Points of which a third are one and the same, and many share coordinates."""
    rng = np.random.default_rng(seed)
    points = rng.integers(0, 12, size=(n, dims)).astype(float) + rng.random((n, dims)) * (rng.random((n, 1)) < 0.5)
    points[rng.random(n) < copies] = 3.25
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id bigint, features array<double>")
    return df, points


def brute(queries, others, k, exclude):
    out = {}
    for i, q in enumerate(queries):
        d2 = np.nan_to_num((others - q) ** 2).sum(axis=1)
        ranked = sorted((d, j) for j, d in enumerate(d2) if not (exclude and i == j))
        out[i] = [j for _, j in ranked[:k]]
    return out


@pytest.fixture
def small_leaves(monkeypatch):
    monkeypatch.setattr(neighbors, "PART_ROWS", 40)
    monkeypatch.setattr(neighbors, "TREE_LEAF", 4)
    monkeypatch.setattr(neighbors, "QUERY_CHUNK", 30)
    monkeypatch.setattr(neighbors, "CANDIDATE_CHUNK", 25)
    monkeypatch.setattr(tree, "BLOCK", 500)


@pytest.mark.parametrize("dims, k, exclude", [(1, 3, True), (3, 7, True), (3, 1, False), (6, 5, True)])
def test_nearest_matches_brute_force(spark, small_leaves, dims, k, exclude):
    df, points = cloud(spark, 500, dims, seed=dims)
    found = neighbors.nearest(df, df, k, query_key="id", candidate_key="id", exclude_self=exclude)
    got = {}
    for r in sorted(found.collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["neighbor_id"])
    assert got == brute(points, points, k, exclude)


@pytest.mark.parametrize("parted", [True, False])
def test_nearest_measures_only_what_a_query_has(spark, request, parted):
    if parted:
        request.getfixturevalue("small_leaves")
    df, points = cloud(spark, 400, 4, seed=51)
    rng = np.random.default_rng(52)
    asked = points[:150].copy()
    asked[rng.random(asked.shape) < 0.4] = np.nan  # some rows have no entry at all
    queries = spark.createDataFrame(
        [(i, [None if np.isnan(x) else float(x) for x in p]) for i, p in enumerate(asked)],
        "id bigint, features array<double>")
    found = neighbors.nearest(queries, df, 5, query_key="id", candidate_key="id", exclude_self=True)
    got = {}
    for r in sorted(found.collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["neighbor_id"])
    assert got == brute(asked, points, 5, True)


def test_nearest_grows_where_a_partition_has_too_few_rows(spark, small_leaves):
    df, points = cloud(spark, 400, 2, seed=61)
    asked, far = cloud(spark, 60, 2, seed=62)
    queries = asked.withColumn("features", F.transform("features", lambda x: x * 40))
    found = neighbors.nearest(queries, df, 90, query_key="id", candidate_key="id")
    got = {}
    for r in sorted(found.collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["neighbor_id"])
    assert got == brute(far * 40, points, 90, False)


@pytest.mark.parametrize("n, d, leaf", [(1, 1, 4), (7, 2, 4), (300, 3, 5), (1000, 2, 32), (64, 6, 1)])
def test_point_tree(n, d, leaf):
    rng = np.random.default_rng(n)
    points = np.round(rng.standard_normal((n, d)), 1)  # with ties
    queries = np.round(rng.standard_normal((80, d)) * 1.5, 1)
    queries[rng.random(queries.shape) < 0.2] = np.nan
    made = tree.PointTree(points, leaf)
    assert sorted(np.concatenate([made.members(x) for x in range(made.leaves)]).tolist()) == list(range(n))
    far = tree.squared(queries, points)
    k = min(3, n)
    rows, columns, dist = made.nearest(queries, np.full(80, np.inf), k, None)
    want = [sorted((far[q, j], j) for j in range(n))[:k] for q in range(80)]
    assert [(a, b) for a, b in zip(dist, columns)] == [x for w in want for x in w]
    r2 = rng.choice([0.0, 0.25, 1.0, 100.0, np.inf], 80)
    weight = rng.integers(1, 5, n)
    assert made.weight_within(queries, r2, weight).tolist() == ((far < r2[:, None]) * weight).sum(axis=1).tolist()
    rows, leaves, inside = made.count(queries, r2)
    for q, leaf_ in zip(rows, leaves):
        inside[q] += (far[q, made.members(leaf_)] < r2[q]).sum()
    assert inside.tolist() == (far < r2[:, None]).sum(axis=1).tolist()
    ball = made.radius(queries, k)
    assert all((far[q] <= ball[q]).sum() >= k for q in range(80))


def test_point_tree_with_many_ties_opens_few_leaves():
    """Points on 5 lines: cuts between lines do not keep queries from the leaves next to them."""
    rng = np.random.default_rng(3)
    points = np.column_stack([rng.random(15_000), rng.choice([3.0, 4.0, 4.0, 4.0, 5.0], 15_000)])
    queries = np.column_stack([rng.random(2_000), rng.choice([3.0, 4.0, 5.0], 2_000)])
    made = tree.PointTree(points, 32)
    first = made.closest_leaf(queries)
    far = [np.sort(tree.squared(queries[i : i + 1], points[made.members(x)])[0])[1] for i, x in enumerate(first)]
    _, leaves = made.visit(queries, np.array(far))
    assert len(leaves) < 2 * len(queries)


@pytest.mark.parametrize("n, gaps, offset", [(4_000, 0.0, 0.0), (4_000, 0.2, 1e6), (900, 0.3, 0.0)])
def test_point_tree_in_many_dimensions(monkeypatch, n, gaps, offset):
    monkeypatch.setattr(tree, "WIDE_LEAF", 64)
    monkeypatch.setattr(tree, "BLOCK", 3_000)
    monkeypatch.setattr(tree, "PAIRS", 500)
    rng = np.random.default_rng(n)
    points = np.round(rng.standard_normal((n, 20)), 1) + offset
    points[n // 2 :: 7] = points[0]  # copies
    own = np.arange(150)
    queries = points[:150].copy()
    queries[rng.random(queries.shape) < gaps] = np.nan
    made = tree.PointTree(points, 4)
    far = tree.squared(queries, points)
    r2 = np.sort(far, axis=1)[:, 9]
    weight = rng.integers(1, 5, n)
    assert made.weight_within(queries, r2, weight).tolist() == ((far < r2[:, None]) * weight).sum(axis=1).tolist()
    far[own, own] = np.inf
    rows, columns, dist = made.nearest(queries, np.full(150, np.inf), 6, own)
    want = [sorted((far[q, j], j) for j in range(n))[:6] for q in range(150)]
    assert [(a, b) for a, b in zip(dist, columns)] == [x for w in want for x in w]


def test_search_holds_few_pairs_in_many_dimensions(monkeypatch):
    """Without bounds nearly all pairs of this size would be held at once: 640 MB and more."""
    rng = np.random.default_rng(8)
    points = rng.standard_normal((20_000, 12))
    tracemalloc.start()
    tree.PointTree(points, 32).nearest(points[:2_000] * 3, np.full(2_000, np.inf), 5, None)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20


@pytest.mark.parametrize("dims", [2, 12])
def test_search_holds_few_of_many_ties(monkeypatch, dims):
    """Queries with a single entry are as far from a whole group of points: only lower ones are held once k are found."""
    rng = np.random.default_rng(16)
    points = np.column_stack([rng.random((20_000, dims - 1)), rng.integers(0, 5, 20_000)])
    queries = np.full((400, dims), np.nan)
    queries[:, -1] = rng.integers(0, 5, 400)
    held, plain = [], tree._first
    monkeypatch.setattr(tree, "_first", lambda found, k: held.append(sum(len(x[0]) for x in found)) or plain(found, k))
    monkeypatch.setattr(tree, "BLOCK", 10_000)
    rows, columns, dist = tree.PointTree(points, 32).nearest(queries, np.full(400, np.inf), 5, None)
    want = [np.flatnonzero(points[:, -1] == q)[:5].tolist() for q in queries[:, -1]]
    assert columns.reshape(400, 5).tolist() == want and not dist.any()
    # all ties: 1,600,000
    assert sum(held) < 800_000


def test_search_measures_few_pairs_in_many_dimensions(monkeypatch):
    """Limits fall with each leaf, so products leave few pairs to be measured exactly."""
    rng = np.random.default_rng(12)
    points, seen, plain = rng.standard_normal((40_000, 24)), [], tree.pair_squared
    monkeypatch.setattr(tree, "pair_squared", lambda x, y: seen.append(len(x)) or plain(x, y))
    rows, columns, _ = tree.PointTree(points, 32).nearest(points[:1_000], np.full(1_000, np.inf), 5, np.arange(1_000))
    far = tree.squared(points[:100], points)
    far[np.arange(100), np.arange(100)] = np.inf
    assert columns[:500].tolist() == np.argsort(far, axis=1, kind="stable")[:, :5].ravel().tolist()
    assert sum(seen) < 25 * 1_000


@pytest.mark.parametrize("spread, step", [(1e7, 1.0), (1e14, 1e7), (1.0, 1e-9), (1e-20, 1e-21)])
@pytest.mark.parametrize("gaps", [0.0, 0.2])
def test_search_where_single_precision_is_too_rough(spread, step, gaps):
    rng = np.random.default_rng(14)
    centres = rng.standard_normal((6, 12)) * spread
    points = centres[rng.integers(0, 6, 5_000)] + step * rng.standard_normal((5_000, 12))
    queries = points[:90] + step * rng.standard_normal((90, 12))
    queries[rng.random(queries.shape) < gaps] = np.nan
    made = tree.PointTree(points, 32)
    far = tree.squared(queries, points)
    rows, columns, dist = made.nearest(queries, np.full(90, np.inf), 4, None)
    order = np.argsort(far, axis=1, kind="stable")[:, :4]
    assert columns.tolist() == order.ravel().tolist()
    assert dist.tolist() == np.take_along_axis(far, order, axis=1).ravel().tolist()
    r2 = np.sort(far, axis=1)[:, 1_000]
    for weight in (np.ones(5_000, dtype=np.int64), rng.integers(1, 5, 5_000)):
        assert made.weight_within(queries, r2, weight).tolist() == ((far < r2[:, None]) * weight).sum(axis=1).tolist()


@pytest.mark.parametrize("parted", [True, False])
def test_nearest_and_counts_in_many_dimensions(spark, monkeypatch, parted):
    if parted:
        monkeypatch.setattr(neighbors, "PART_ROWS", 60)
        monkeypatch.setattr(neighbors, "WIDE_VALUES", 600)
        monkeypatch.setattr(neighbors, "WIDE_QUERIES", 30)
    df, points = cloud(spark, 400, 12, seed=71)
    found = neighbors.nearest(df, df, 4, query_key="id", candidate_key="id", exclude_self=True)
    got = {}
    for r in sorted(found.collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["neighbor_id"])
    assert got == brute(points, points, 4, True)
    counted = neighbors.count_within(
        df.withColumn("r2", F.lit(16.0)), df, query_key="id", candidate_key="id", radius="r2")
    d2 = tree.squared(points, points)
    assert {r["query_id"]: r["n"] for r in counted.collect()} == dict(enumerate((d2 < 16.0).sum(axis=1).tolist()))


def test_closest_distances_are_searched_once(spark):
    df, _ = cloud(spark, 60, 2, seed=5)
    closest = privacy.closest_distances(df, df, "id")
    assert "CoGroups" not in closest._jdf.queryExecution().toString()


def test_search_opens_few_leaves():
    rng = np.random.default_rng(9)
    points = rng.standard_normal((50_000, 3))
    made = tree.PointTree(points, 32)
    queries = rng.standard_normal((200, 3))
    rows, _, dist = made.nearest(queries, np.full(200, np.inf), 5, None)
    _, leaves = made.visit(queries, dist[4::5])
    assert len(leaves) < 200 * 30 < 200 * made.leaves / 30


def test_nearest_on_a_small_table(spark):
    df, points = cloud(spark, 300, 3, seed=31)
    found = neighbors.nearest(df, df, 6, query_key="id", candidate_key="id", exclude_self=True)
    got = {}
    for r in sorted(found.collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["neighbor_id"])
    assert got == brute(points, points, 6, True)


def test_nearest_with_text_keys(spark, small_leaves):
    df, points = cloud(spark, 150, 2, seed=41)
    df = df.withColumn("id", F.lpad(F.col("id").cast("string"), 5, "0"))
    found = neighbors.nearest(df, df, 3, query_key="id", candidate_key="id", exclude_self=True)
    got = {}
    for r in sorted(found.collect(), key=lambda r: r["rank"]):
        got.setdefault(int(r["query_id"]), []).append(int(r["neighbor_id"]))
    assert got == brute(points, points, 3, True)


def test_nearest_between_tables(spark, small_leaves):
    a, pa = cloud(spark, 220, 3, seed=11, copies=0.0)
    b, pb = cloud(spark, 350, 3, seed=12)
    found = neighbors.nearest(a, b, 4, query_key="id", candidate_key="id")
    got = {}
    for r in sorted(found.collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["neighbor_id"])
    assert got == brute(pa, pb, 4, False)


def test_nearest_rejects_large_k(spark):
    df, _ = cloud(spark, 5, 2, seed=1)
    with pytest.raises(ValueError, match="Expected k between 1 and 4"):
        neighbors.nearest(df, df, 5, query_key="id", candidate_key="id", exclude_self=True)


def test_count_within_matches_brute_force(spark, small_leaves):
    df, points = cloud(spark, 500, 3, seed=21)
    rng = np.random.default_rng(3)
    radii = rng.choice([0.0, 1.0, 40.0, 500.0], size=500)
    queries = spark.createDataFrame(
        [(i, p.tolist(), float(r)) for i, (p, r) in enumerate(zip(points, radii))],
        "id bigint, features array<double>, r2 double",
    )
    out = neighbors.count_within(queries, df, query_key="id", candidate_key="id", radius="r2")
    got = {r["query_id"]: r["n"] for r in out.collect()}
    want = {i: int((((points - p) ** 2).sum(axis=1) < r).sum()) for i, (p, r) in enumerate(zip(points, radii))}
    assert got == want


def test_partition_covers_every_point(spark, small_leaves):
    df, points = cloud(spark, 400, 2, seed=8)
    partition = neighbors.fit_partition(df, "features", "id", 400)
    leaves = partition.assign(points)
    assert partition.depth == 4
    assert leaves.min() >= 0 and leaves.max() < partition.leaves


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_splits_hot_keys(spark, make, monkeypatch, how):
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 5)
    monkeypatch.setattr(sizing, "HOT_ROWS", 20)
    left = make("g string, v bigint", g=["h"] * 60 + [None] * 30 + [f"k{i % 40}" for i in range(60)],
                v=list(range(150)))
    right = spark.createDataFrame([("h", 7)] + [(f"k{i}", i) for i in range(30)], "g string, w bigint")
    assert [tuple(r) for r in sizing.hot_keys(left, "g").collect()] == [("h", 3)]
    got, want = sizing.lookup(left, right, "g", how=how), left.join(right, "g", how)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_wide_rows_are_not_small(spark, monkeypatch):
    wide = spark.range(50).selectExpr("id", "repeat('x', 1000) as t", "array_repeat(1.0, 10) as a")
    assert sizing.is_small(wide)
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 40_000)
    assert not sizing.is_small(wide) and sizing.is_small(wide.select("id"))


# -- quantiles and ordinals --------------------------------------------------------------------

@pytest.mark.parametrize("values", [
    list(range(1000)), [5.0] * 700 + list(range(300)), [1.0] * 500 + [2.0] * 500,
])
def test_rank_selection_narrows_exactly(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    ordered = sorted(values)
    for rank in (0, 1, 333, 499, 500, 998, 999):
        assert quantiles.value_at_rank(df, rank, len(values), small=20) == ordered[rank]


def test_exact_quantiles_on_both_paths(spark, monkeypatch):
    rng = np.random.default_rng(1)
    values = rng.normal(size=800).round(2)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    probs = [0.0, 0.05, 0.31, 0.5, 0.99, 1.0]
    want = np.quantile(values, probs)
    assert quantiles.exact_quantiles(df, "v", probs) == pytest.approx(want)
    monkeypatch.setattr(quantiles, "SMALL", 50)
    assert quantiles.exact_quantiles(df, "v", probs) == pytest.approx(want)


def test_grouped_quantiles_with_a_hot_group(hot):
    out = quantiles.grouped_quantiles(hot, ["g"], "v", [0.25, 0.5], max_group_rows=20)
    got = {r["g"]: (r["q0"], r["q1"]) for r in out.collect()}
    pdf = hot.toPandas()
    want = pdf.groupby("g")["v"].quantile([0.25, 0.5]).unstack()
    for g, (a, b) in got.items():
        assert (a, b) == pytest.approx(tuple(want.loc[g]))


def test_hash_ordinal_is_dense(make, monkeypatch):
    monkeypatch.setattr(ordinal, "BUCKET_ROWS", 10)
    df = make("v bigint", v=list(range(300)))
    out = rows_of(ordinal.hash_ordinal(df, "k", seed=3, stream="x", output="at", leading=F.col("v") % 100 == 7))
    assert sorted(out["at"]) == list(range(300))
    assert [out["at"][i] for i in (7, 107, 207)] == [0, 1, 2]
    # many leading rows are ranked over several ranges of keys; a null leads nothing
    lead = F.when(F.col("v") < 290, F.col("v") % 2 == 0)
    out = rows_of(ordinal.hash_ordinal(df, "k", seed=3, stream="x", output="at", leading=lead))
    assert sorted(out["at"]) == list(range(300))
    assert [out["at"][i] for i in range(0, 290, 2)] == list(range(145))


def test_pair_moments_in_tiles(spark, monkeypatch):
    rng = np.random.default_rng(33)
    x = rng.standard_normal((200, 7)) * [1, 1, 5, 1, 1e-3, 1, 1] + [0, 1e6, 0, 3, 0, -2, 0]
    x[:, 3] = 4.0
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 5][~np.isnan(x[:, 6])] = np.nan  # never present together
    names = [f"c{i}" for i in range(7)]
    df = spark.createDataFrame([[None if np.isnan(v) else float(v) for v in row] for row in x],
                               ", ".join(f"{c} double" for c in names)).repartition(3)
    from maskloom.operators.metrics.signal import correlations

    for tile in (256, 3):
        monkeypatch.setattr(comoments, "TILE", tile)
        got = {(r["a"], r["b"]): r["rho"] for r in correlations(df, names).collect()}
        assert len(got) == 49
        for i in range(7):
            for j in range(7):
                both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
                want = None if 3 in (i, j) or both.sum() < 2 else np.corrcoef(x[both, i], x[both, j])[0, 1]
                assert got[f"c{i}", f"c{j}"] == (None if want is None else pytest.approx(want, abs=1e-9))
