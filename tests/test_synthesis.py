"""Synthesis, metrics, linked tables, series and end-to-end runs on the small fixtures."""

from __future__ import annotations

import itertools

import numpy as np
import pytest
from conftest import FIXTURES, SMALL, rows_of
from pyspark.sql import functions as F

from maskloom.operators import assignment, neighbors, tree
from maskloom.operators import multitable as mt
from maskloom.operators import timeseries as ts
from maskloom.operators.metrics import privacy, signal
from maskloom.operators.processors import (
    DatetimeProcessor,
    InterRecordCumulatedDifferenceProcessor,
    ProportionProcessor,
    RelativeDifferenceProcessor,
)
from maskloom.operators.synthesis.encode import fit_encoder
from maskloom.operators.synthesis.generate import (
    complete,
    attach_excluded,
    neighbor_weights,
    shuffle_rows,
    synthesize,
)
from maskloom.operators.synthesis.impute import impute
from maskloom.operators.synthesis.noise import private_rows
from maskloom.operators.synthesis.project import fit_space
from maskloom.operators.synthesis.sparse import fit_sparse_space
from maskloom.plans.parameters import Parameters, ParameterSet
from maskloom.plans.pipeline import Pipeline
from maskloom.plans.run import advise_parameters, run
from maskloom.plans.specs import DatasetSpec
from maskloom.session import materialize
from maskloom.sources.tables import read_csv
from maskloom.streaming.apply import preprocess_stream


@pytest.fixture(scope="module")
def iris(spark):
    df = read_csv(spark, f"{FIXTURES}/iris.csv")
    names = [c.replace(".", "_") for c in df.columns]
    pdf = df.toPandas()
    pdf.columns = names
    pdf["id"] = range(len(pdf))
    return spark.createDataFrame(pdf).cache()


FLOWER = ["sepal_length", "sepal_width", "petal_length", "petal_width"]


def test_projection_matches_numpy(iris):
    columns = [*FLOWER, "variety"]
    space = fit_space(iris, columns, row_key="id", ncp=3)
    got = np.array([r["features"] for r in space.place(iris, "id").orderBy("id").collect()])
    pdf = iris.toPandas().sort_values("id")
    x = pdf[FLOWER].to_numpy()
    x = (x - x.mean(0)) / x.std(0)
    ones = np.stack([(pdf["variety"] == v).to_numpy(dtype=float) for v in sorted(pdf["variety"].unique())], 1)
    full = np.hstack([x, (ones - ones.mean(0)) / np.sqrt(ones.mean(0))])
    values, vectors = np.linalg.eigh(np.cov(full.T))
    vectors = vectors[:, ::-1][:, :3]
    vectors *= np.sign(vectors[np.abs(vectors).argmax(0), range(3)])
    assert np.abs(got[:, :2] - (full @ vectors)[:, :2]).max() < 1e-6
    shares = values[::-1][:3] / values.sum()
    total = {}
    for c, j, v in space.contributions():
        total[j] = total.get(j, 0) + v
    assert [total[j + 1] for j in range(3)] == pytest.approx(shares, abs=1e-6)


def test_categorical_reduction_keeps_rows(iris):
    space = fit_space(iris, [*FLOWER, "variety"], row_key="id", ncp=4, use_categorical_reduction=True)
    out = space.place(iris, "id")
    assert out.count() == 150 and len(out.first()["features"]) == 4


def test_constant_columns_and_quotes(make):
    df = make("a double, b string", a=[1.0, 1.0, 1.0], b=["it's", "a\\b", "it's"])
    out = fit_encoder(df, ["a", "b"]).encode(df, "k").orderBy("k").collect()
    assert out[0]["features"][0] == 0.0
    assert out[0]["features"] == out[2]["features"] != out[1]["features"]


def test_synthesis_shape_and_determinism(iris):
    made = synthesize(iris, "id", k=5, ncp=3, seed=3)
    again = synthesize(iris.repartition(7), "id", k=5, ncp=3, seed=3)
    a, b = (m.unshuffled.orderBy("id").toPandas() for m in (made, again))
    assert made.unshuffled.dtypes == [("id", "bigint")] + [(c, t) for c, t in iris.dtypes if c != "id"]
    assert np.abs(a[FLOWER].to_numpy() - b[FLOWER].to_numpy()).max() < 1e-9
    assert (a["variety"] == b["variety"]).all()
    source = iris.toPandas()
    for c in FLOWER:
        assert a[c].min() >= source[c].min() and a[c].max() <= source[c].max()
    other = shuffle_rows(made.unshuffled, "id", seed=9).toPandas()
    assert sorted(other["id"]) == list(range(150))
    key = [*FLOWER, "variety"]
    assert (other[key].sort_values(key).to_numpy() == a[key].sort_values(key).to_numpy()).all()


def test_synthesis_rejects_large_k(iris):
    with pytest.raises(ValueError, match="Expected k between"):
        synthesize(iris, "id", k=150, ncp=2)


def test_weights_are_per_row(make):
    df = make("query_id bigint, neighbor_id bigint, distance double", key=False,
              query_id=[1, 1, 2], neighbor_id=[2, 3, 1], distance=[0.0, 1.0, 2.0])
    out = neighbor_weights(df, 1).collect()
    assert len(out) == 3 and all(r["weight"] > 0 for r in out)


@pytest.fixture
def holes(make):
    return make(
        "x double, n int, c string",
        x=[1.0, None, 3.0, 4.0, 5.0, 40.0], n=[1, 2, 3, None, 5, 40],
        c=["a", "b", "b", "a", None, "a"],
    )


def test_imputation(holes):
    assert rows_of(impute(holes, ["x", "n", "c"], method="mean", row_key="k")) == {
        "x": [1.0, 10.6, 3.0, 4.0, 5.0, 40.0], "n": [1, 2, 3, 10, 5, 40], "c": list("abba") + ["a", "a"]}
    assert rows_of(impute(holes, ["x"], method="median", row_key="k"))["x"][1] == 4.0
    assert rows_of(impute(holes, ["c"], method="mode", row_key="k"))["c"][4] == "a"
    near = rows_of(impute(holes, ["x", "n", "c"], method="knn", row_key="k", k=2))
    assert near["x"][1] == 2.0 and near["c"][4] == "a" and None not in near["n"]
    with pytest.raises(ValueError, match="Expected an imputation method"):
        impute(holes, ["x"], method="nope", row_key="k")


def test_missing_values_come_back(spark):
    rows = [(i, None if i % 2 else float(i), "v") for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, x double, c string")
    out = synthesize(df, "id", k=5, ncp=2, imputation_method="mean", seed=1).unshuffled
    missing = out.where("x is null").count()
    assert 15 <= missing <= 45


@pytest.mark.parametrize("strategy", ["row_order", "coordinate_similarity"])
def test_excluded_variables(iris, strategy):
    made = synthesize(iris, "id", k=5, ncp=None, columns=FLOWER, seed=2)
    out = attach_excluded(made, iris, ["variety"], strategy=strategy)
    assert out.count() == 150 and out.where("variety is null").count() == 0
    if strategy == "row_order":
        assert out.join(iris.select("id", F.col("variety").alias("v")), "id").where("v <> variety").count() == 0


def test_private_rows_noise_scale(spark):
    df = spark.range(4000).select("id", F.lit(5.0).alias("x"), F.lit("a").alias("c"))
    out = private_rows(df, "id", epsilon=4.0, bounds={"x": (-1000.0, 1000.0)}, modalities={"c": ["a", "b", "d"]},
                       preprocess_budget_ratio=0.5, seed=4)
    # two columns share half of epsilon: one unit each
    spread = out.where("abs(x) < 999").agg(F.expr("percentile(abs(x - 5), 0.5)")).first()[0]
    assert spread < 2000 * 1.0 * np.log(2) * 1.1
    kept = out.where("c = 'a'").count() / 4000
    assert kept == pytest.approx(np.e / (np.e + 2), abs=0.03)
    with pytest.raises(ValueError, match="epsilon"):
        private_rows(df, "id", epsilon=0, bounds={}, modalities={})


# -- metrics -----------------------------------------------------------------------------------

def points(spark, values):
    return spark.createDataFrame([(i, [float(v)]) for i, v in enumerate(values)], "id bigint, features array<double>")


def test_privacy_metrics_by_hand(spark):
    a = points(spark, [0, 10, 20, 30])
    b = points(spark, [1, 2, 21, 100])
    # nearest synthetic: 0->0, 10->1, 20->2, 30->2
    assert privacy.hidden_rate(a, b, "id") == 25.0
    counts = {r["query_id"]: r["n"] for r in privacy.cloaking_counts(a, b, "id").collect()}
    assert counts == {0: 0, 1: 0, 2: 0, 3: 3}
    assert privacy.local_cloaking(a, b, "id") == 0.0
    closest = privacy.closest_distances(a, b, "id")
    got = {r["query_id"]: (r["d1"], round(r["ratio"], 6)) for r in closest.collect()}
    assert got == {0: (1.0, round(1 / 9, 6)), 1: (2.0, 0.25), 2: (1.0, round(1 / 9, 6)), 3: (70.0, 0.875)}
    assert privacy.distance_to_closest(closest)["dcr_median"] == 1.5
    assert privacy.closest_rate(a, closest, "id", percentage_threshold=0.5, ratio_threshold=0.2) == 50.0


def test_direct_matches(make):
    a = make("x bigint, c string", x=[1, 2, 3, None], c=["a", "b", None, "d"])
    b = make("x bigint, c string", x=[1, 5, 3, None], c=["a", "b", "z", "d"])
    got = {r["column"]: r["protection"] for r in privacy.column_direct_match(a, b, "k", ["x", "c"]).collect()}
    assert got == {"x": 25.0, "c": 25.0}
    assert privacy.row_direct_match_protection(a, b, ["x", "c"]) == 50.0


def test_least_assignment_keeps_pairs_that_are_least():
    """On a line the sorted pairs are least: no path is searched."""
    rng = np.random.default_rng(23)
    x = np.sort(rng.random(200))
    cost = assignment.distances(x[:, None], np.sort(x + rng.random(200) * 0.1)[:, None])
    row_price, column_price, owner = assignment.kept_pairs(cost)
    assert (owner >= 0).mean() > assignment.KEPT_SHARE
    assert (cost - row_price[:, None] - column_price[None, :]).min() > -1e-12
    mixed = rng.permutation(200)
    for c in (cost, cost[:, mixed]):
        cold, warm = assignment.least_assignment(c), assignment.least_assignment(c, True)
        rows = np.arange(200)
        assert sorted(warm) == rows.tolist()
        assert c[rows, warm].sum() == pytest.approx(c[rows, cold].sum(), abs=1e-9)


def test_rows_with_cheapest_columns_of_their_own_search_no_path():
    rng = np.random.default_rng(29)
    cost = rng.random((40, 40)) + 2
    order = rng.permutation(40)
    cost[np.arange(40), order] -= 1.5
    row_price, column_price, owner = assignment._reduced(cost)
    assert owner[order].tolist() == list(range(40))
    assert assignment.least_assignment(cost).tolist() == order.tolist()
    assert len(assignment.least_assignment(np.zeros((0, 0)))) == 0
    with pytest.raises(ValueError, match="no distance"):
        assignment.least_assignment(np.array([[1.0, np.nan], [np.nan, np.nan]]))
    # prices bear out what is taken, whatever is left free
    for c in (rng.random((60, 60)), rng.integers(0, 5, (60, 60)).astype(float), np.zeros((7, 7))):
        row_price, column_price, owner = assignment._reduced(c)
        over = c - row_price[:, None] - column_price[None, :]
        held = np.flatnonzero(owner >= 0)
        assert over.min(initial=0.0) >= -1e-12 and not over[owner[held], held].any()
        assert len(set(owner[held])) == len(held) and sorted(assignment.least_assignment(c)) == list(range(len(c)))


def test_series_components_write_no_long_table(spark, monkeypatch):
    df = spark.range(60).select(
        F.col("id"), (F.col("id") % 6).alias("u"), F.col("id").cast("double").alias("t"), F.sin("id").alias("v"))
    written = []
    keep = ts.materialize
    monkeypatch.setattr(ts, "materialize", lambda x: written.append(keep(x)) or written[-1])
    aligned = ts.align(df, "u", "t", ["v"], "id", method="specified", nb_points=500)
    ts.fit_series_components(aligned, "u", ["v"], 500, nf=2, passes=1)
    assert aligned.count() == 3_000
    assert max(x.count() for x in written) <= 500


@pytest.mark.parametrize("compare_cost", [0.0, 1.5e-10, 1e9])
def test_categorical_hidden_rate_of_many_columns(spark, monkeypatch, compare_cost):
    """All pairs compared, both ways in turn, and keys of blocks only."""
    monkeypatch.setattr(privacy, "COMPARE_COST", compare_cost)
    monkeypatch.setattr(privacy, "COMPARED_ROWS", 100)
    rng = np.random.default_rng(17)
    n, sizes = 300, [2, 3, 4, 5, 2, 3, 4, 300]
    a = np.column_stack([rng.integers(0, k, n) for k in sizes])
    moved = rng.random(a.shape) < 0.35
    b = np.where(moved, (a + 1) % sizes, a)
    b[::9], a[::11] = b[0], a[0]
    frame = lambda x: spark.createDataFrame(
        [(i, *[None if v == 1 else int(v) for v in p]) for i, p in enumerate(x)],
        "id bigint, " + ", ".join(f"c{i} int" for i in range(len(sizes))))
    far = (a[:, None, :] != b[None, :, :]).sum(axis=2)
    least = far.min(axis=1)
    own = far[np.arange(n), np.arange(n)]
    rate = np.where(own > least, 1.0, 1 - 1 / (far == least[:, None]).sum(axis=1))
    got = privacy.categorical_hidden_rate(frame(a), frame(b), "id", [f"c{i}" for i in range(len(sizes))])
    assert got == pytest.approx(100 * rate.mean(), abs=1e-9)


@pytest.mark.parametrize("compare_cost", [0.0, 1e9])
def test_categorical_hidden_rate_broadcasts_no_rows(spark, monkeypatch, compare_cost):
    """Rows of few values are small in a file and large in memory."""
    monkeypatch.setattr(privacy, "COMPARE_COST", compare_cost)
    plans, keep = [], privacy.materialize

    def spy(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df)

    monkeypatch.setattr(privacy, "materialize", spy)
    rows = [(i, i % 2, i % 3, i % 5) for i in range(200)]
    a = spark.createDataFrame(rows, "id bigint, p int, q int, r int")
    b = a.withColumn("q", (F.col("q") + F.col("id") % 2) % 3)
    rate = privacy.categorical_hidden_rate(a, b, "id", ["p", "q", "r"])
    x, y = (np.array([r[1:] for r in sorted(t.collect())]) for t in (a, b))
    far = (x[:, None, :] != y[None, :, :]).sum(axis=2)
    own = (far[np.arange(200), np.arange(200)] == far.min(axis=1)) / (far == far.min(axis=1)[:, None]).sum(axis=1)
    assert rate == pytest.approx(100 * (1 - own.mean()))
    assert any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)


@pytest.mark.parametrize(("sizes", "numbered"), [([2, 3, 9, 40, 2, 6], 2_000), ([2, 3, 400, 4], 2_000), ([3, 2, 5], 4), ([2] * 300, 2_000)])
def test_categorical_hidden_rate_of_few_and_many_values(spark, monkeypatch, sizes, numbered):
    """Bits of words, numbers, and values that are not numbered for all tasks; values that only one side has."""
    monkeypatch.setattr(privacy, "COMPARE_COST", 0.0)
    monkeypatch.setattr(privacy, "NUMBERED_VALUES", numbered)
    monkeypatch.setattr(privacy, "TILE", (7, 50))
    rng = np.random.default_rng(31)
    n, m = 150, len(sizes)
    a = np.column_stack([rng.integers(0, k, n) for k in sizes])
    b = np.where(rng.random(a.shape) < 0.3, (a + 1) % (np.array(sizes) + 1), a)
    frame = lambda x: spark.createDataFrame(
        [(i, *map(int, p)) for i, p in enumerate(x)], "id bigint, " + ", ".join(f"c{i} int" for i in range(m)))
    far = (a[:, None, :] != b[None, :, :]).sum(axis=2)
    least, own = far.min(axis=1), far[np.arange(n), np.arange(n)]
    rate = np.where(own > least, 1.0, 1 - 1 / (far == least[:, None]).sum(axis=1))
    got = privacy.categorical_hidden_rate(frame(a), frame(b), "id", [f"c{i}" for i in range(m)])
    assert got == pytest.approx(100 * rate.mean(), abs=1e-9)


def test_categorical_hidden_rate_brute_force(spark):
    rng = np.random.default_rng(2)
    a, b = (rng.integers(0, 3, size=(60, 3)) for _ in range(2))
    schema = "id bigint, p string, q string, r string"

    def frame(x):
        return spark.createDataFrame(
            [(i, *[None if v == 2 and j == 1 else str(v) for j, v in enumerate(row)]) for i, row in enumerate(x.tolist())], schema)

    hidden = 0.0
    for i, row in enumerate(a):
        d = (b != row).sum(axis=1)
        ties = np.flatnonzero(d == d.min())
        hidden += 1 - (i in ties) / len(ties)
    got = privacy.categorical_hidden_rate(frame(a), frame(b), "id", ["p", "q", "r"])
    assert got == pytest.approx(100 * hidden / 60)


def test_signal_metrics_on_equal_tables(iris):
    columns = [*FLOWER, "variety"]
    out = signal.hellinger(iris, iris, columns)
    assert out["hellinger_mean"] == pytest.approx(0.0, abs=1e-6)
    assert signal.correlation_difference_ratio(iris, iris, FLOWER) == 0.0
    rho = {(r["a"], r["b"]): r["rho"] for r in signal.correlations(iris, FLOWER).collect()}
    want = iris.toPandas()[FLOWER].corr()
    assert all(rho[a, b] == pytest.approx(want.loc[a, b]) for a in FLOWER for b in FLOWER)


def test_correlation_of_a_constant_is_null(make):
    df = make("a double, b double", a=[1.0, 2.0], b=[5.0, 5.0]).drop("k")
    rho = {(r["a"], r["b"]): r["rho"] for r in signal.correlations(df, ["a", "b"]).collect()}
    assert rho["a", "b"] is None and rho["a", "a"] == pytest.approx(1.0)


# -- linked tables and series ------------------------------------------------------------------

def test_assignment_is_optimal():
    rng = np.random.default_rng(7)
    for n in (1, 2, 3, 5, 6):
        for _ in range(20):
            cost = rng.integers(0, 9, size=(n, n)).astype(float)
            chosen = assignment.least_assignment(cost)
            assert sorted(chosen) == list(range(n))
            best = min(sum(cost[i, p[i]] for i in range(n)) for p in itertools.permutations(range(n)))
            assert cost[np.arange(n), chosen].sum() == best


def test_assign_parents_in_blocks(spark):
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=90), rng.normal(size=90)
    out = assignment.assign_parents(points(spark, x), points(spark, y), "id", block_rows=16).toPandas()
    assert sorted(out["parent_id"]) == sorted(out["synthetic_id"]) == list(range(90))
    # on a line the sorted matching is optimal and blocks do not break it
    assert out["distance"].sum() == pytest.approx(np.abs(np.sort(x) - np.sort(y)).sum())


def test_assignment_of_many_blocks_is_near_the_least(spark):
    rng = np.random.default_rng(14)
    n = 1500
    x, y = rng.normal(size=(n, 5)), rng.normal(size=(n, 5)) * 0.9 + 0.2
    cost = assignment.distances(x, y)
    exact = cost[np.arange(n), assignment.least_assignment(cost)].sum()
    a, b = (spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(p)], "id long, features array<double>")
            for p in (x, y))
    made = materialize(assignment.assign_parents(a, b, "id"))
    out = made.toPandas()
    assert sorted(out["parent_id"]) == sorted(out["synthetic_id"]) == list(range(n))
    assert out["distance"].to_numpy() == pytest.approx(cost[out["parent_id"], out["synthetic_id"]])
    assert exact <= out["distance"].sum() + 1e-9 and out["distance"].sum() <= 1.01 * exact
    bound = assignment.assignment_bound(a, b, made, "id", steps=6).first()
    assert bound["total"] == pytest.approx(out["distance"].sum())
    assert 0.95 * exact <= bound["lower_bound"] <= exact + 1e-9


def test_blocks_of_pairs_are_solved_one_to_one(spark):
    rng = np.random.default_rng(24)
    pairs = spark.createDataFrame(
        [(i, x.tolist(), i + 1_000, y.tolist()) for i, (x, y) in enumerate(zip(rng.random((300, 2)), rng.random((300, 2))))],
        "parent_id long, px array<double>, synthetic_id long, sx array<double>")
    for turn in (2, 3):
        blocks = assignment._near_blocks(pairs, 300, 40, turn)
        plan = assignment._solve(blocks, 300, 40, True)
        assert "FlatMapGroupsInArrow" in plan._jdf.queryExecution().executedPlan().toString()
        solved = plan.toPandas()
        sizes = [r["count"] for r in blocks.groupBy("block").count().collect()]
        assert len(sizes) > 4 and sum(sizes) == 300
        assert sorted(solved["parent_id"]) == list(range(300)) and sorted(solved["synthetic_id"]) == list(range(1_000, 1_300))
        apart = np.stack(solved["px"].to_numpy()) - np.stack(solved["sx"].to_numpy())
        assert solved["distance"].to_numpy() == pytest.approx(np.sqrt((apart ** 2).sum(axis=1)))
    whole = spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0, 1.0])], "id long, features array<double>")
    gap = spark.createDataFrame([(1, [0.0, 1.0]), (2, None)], "id long, features array<double>")
    with pytest.raises(Exception, match="no distance"):
        assignment.assign_parents(gap, whole, "id").collect()


def test_assignment_of_few_and_equal_rows(spark):
    def table(rows):
        return spark.createDataFrame(rows, "id long, features array<double>")

    same = table([(i, [1.0, 2.0]) for i in range(40)])
    out = assignment.assign_parents(same, same, "id", block_rows=8).toPandas()
    assert sorted(out["parent_id"]) == sorted(out["synthetic_id"]) == list(range(40)) and not out["distance"].any()
    bound = assignment.assignment_bound(same, same, spark.createDataFrame(out), "id", block_rows=8).first()
    assert bound["total"] == bound["lower_bound"] == 0.0
    a, b = table([(1, [0.0]), (2, [5.0]), (3, [9.0])]), table([(1, [9.5]), (2, [0.5]), (3, [4.0])])
    found = assignment.assign_parents(a, b, "id")
    assert sorted(map(tuple, found.collect())) == [(1, 2, 0.5), (2, 3, 1.0), (3, 1, 0.5)]
    bound = assignment.assignment_bound(a, b, found, "id").first()
    assert bound["lower_bound"] == pytest.approx(2.0) == bound["total"]
    with pytest.raises(ValueError, match="as many"):
        assignment.assign_parents(a, same, "id")


@pytest.mark.parametrize("part_rows", [None, 30])
def test_least_priced_against_all_pairs(spark, monkeypatch, part_rows):
    if part_rows:
        monkeypatch.setattr(neighbors, "PART_ROWS", part_rows)
    rng = np.random.default_rng(15)
    x, y, price = rng.normal(size=(120, 3)), rng.normal(size=(250, 3)), rng.normal(size=250)
    value = assignment.distances(x, y) + price
    a = spark.createDataFrame([(i, v.tolist(), float(value[i, i])) for i, v in enumerate(x)],
                              "id long, features array<double>, limit double")
    b = spark.createDataFrame([(i, v.tolist(), float(p)) for i, (v, p) in enumerate(zip(y, price))],
                              "id long, features array<double>, price double")
    got = {r["query_id"]: (r["neighbor_id"], r["value"]) for r in neighbors.least_priced(a, b).collect()}
    assert got == {i: (int(row.argmin()), pytest.approx(row.min())) for i, row in enumerate(value)}


@pytest.mark.parametrize(("scale", "offset"), [(1.0, 0.0), (1.0, 1e3), (1e-8, 0.0)])
def test_least_priced_in_many_dimensions_by_products(monkeypatch, scale, offset):
    """Few pairs are measured one by one, and the least are those of all pairs, ties to the lower point."""
    rng = np.random.default_rng(19)
    y = scale * (rng.normal(size=(6_000, 20)) + 3 * rng.integers(0, 3, (6_000, 1)) + offset)
    y[50:90] = y[10]
    x = y[rng.permutation(6_000)[:300]] + scale * 0.7 * rng.normal(size=(300, 20))
    price = scale * rng.normal(size=6_000)
    price[50:90] = price[10]
    limit = np.sqrt(((x - y[:300]) ** 2).sum(axis=1)) + price[:300]
    measured, keep = [], tree.pair_squared
    monkeypatch.setattr(tree, "pair_squared", lambda a, b: measured.append(len(a)) or keep(a, b))
    rows, points, value = tree.PointTree(y, 32).least_priced(x, limit, price)
    whole = np.sqrt(tree.squared(x, y)) + price
    assert rows.tolist() == list(range(300))
    assert points.tolist() == whole.argmin(axis=1).tolist() and value.tolist() == whole.min(axis=1).tolist()
    assert 0 < sum(measured) < whole.size / 10


def test_least_priced_of_many_dimensions_and_partitions(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "PART_ROWS", 300)
    monkeypatch.setattr(neighbors, "WIDE_VALUES", 4_000)
    rng = np.random.default_rng(20)
    x, y, price = rng.normal(size=(120, 12)), rng.normal(size=(1_500, 12)), rng.normal(size=1_500)
    value = assignment.distances(x, y) + price
    a = spark.createDataFrame([(i, v.tolist(), float(value[i, i])) for i, v in enumerate(x)],
                              "id long, features array<double>, limit double")
    b = spark.createDataFrame([(i, v.tolist(), float(p)) for i, (v, p) in enumerate(zip(y, price))],
                              "id long, features array<double>, price double")
    got = {r["query_id"]: (r["neighbor_id"], r["value"]) for r in neighbors.least_priced(a, b).collect()}
    assert got == {i: (int(row.argmin()), pytest.approx(row.min())) for i, row in enumerate(value)}


def test_alignment_against_numpy(make):
    t = [0.0, 1.0, 4.0, 10.0, 5.0, 7.0, 3.0]
    v = [1.0, 3.0, 0.0, 6.0, 2.0, 8.0, 9.0]
    df = make("id bigint, t double, v double", id=[0, 0, 0, 0, 1, 1, 2], t=t, v=v)
    for limit in (10**6, 2):
        out = ts.align(df, "id", "t", ["v"], "k", method="specified", nb_points=6, max_group_rows=limit)
        got = out.orderBy("id", "point").toPandas()
        for i, rows in ((0, [0, 1, 2, 3]), (1, [4, 5])):
            grid = np.linspace(t[rows[0]], t[rows[-1]], 6)
            mine = got[got["id"] == i]
            assert mine["t"].to_numpy() == pytest.approx(grid)
            assert mine["v"].to_numpy() == pytest.approx(np.interp(grid, [t[r] for r in rows], [v[r] for r in rows]))
        assert got[got["id"] == 2]["v"].tolist() == [9.0] * 6


def test_common_length(make):
    df = make("id bigint", id=[0, 0, 0, 1])
    assert [ts.common_length(df, "id", m) for m in ("max", "min", "mean")] == [3, 1, 2]
    with pytest.raises(ValueError, match="nb_points"):
        ts.common_length(df, "id", "specified")


# -- plans -------------------------------------------------------------------------------------

def test_pipeline_inverts_in_reverse_order(make):
    df = make("t0 bigint, t1 bigint, t2 bigint", t0=[20, 40, 34], t1=[23, 46, 37], t2=[29, 54, 39])
    chain = Pipeline([RelativeDifferenceProcessor("t2", ["t1"]), RelativeDifferenceProcessor("t1", ["t0"])])
    model = chain.fit(df)
    out = model.preprocess(df)
    assert rows_of(out)["t1"] == [3, 6, 3] and rows_of(out)["t2"] == [6, 8, 2]
    dest = make("t0 bigint, t1 double, t2 double", t0=[22, 38, 34], t1=[4.0, 5.0, 1.0], t2=[5.0, 3.0, 7.0])
    back = rows_of(model.postprocess(df, dest))
    assert back["t1"] == [26, 43, 35] and back["t2"] == [31, 46, 42]


def test_parameters():
    with pytest.raises(ValueError, match="Expected either k or dp_epsilon"):
        Parameters(k=5, dp_epsilon=1.0)
    with pytest.raises(ValueError, match="imputation_method"):
        Parameters(k=5, imputation_method="x")
    first = ParameterSet().set("t", k=5, ncp=3)
    second = first.update("t", ncp=4)
    assert (second.get("t").k, second.get("t").ncp, first.get("t").ncp) == (5, 4, 3)
    assert second.set("t", k=7).get("t").ncp == 5
    with pytest.raises(ValueError, match="Expected parameters among"):
        second.update("t", nope=1)
    with pytest.raises(ValueError, match="Expected parameters for table"):
        second.delete("t").get("t")


@pytest.fixture(scope="module")
def clinic(spark):
    return (
        DatasetSpec("clinic")
        .add_table("patient", f"{FIXTURES}/patient.csv", spark=spark, primary_key="p_id", individual_level=True)
        .add_table("visit", f"{FIXTURES}/visit.csv", spark=spark, primary_key="visit_id",
                   foreign_keys=("patient_id", "doctor_id"))
        .add_link("patient", "p_id", "visit", "patient_id")
    )


def test_dataset_changes(clinic):
    assert clinic.parents_first() == ["patient", "visit"]
    assert clinic.drop_table("patient").links == ()
    assert clinic.drop_links("visit").links == () and len(clinic.links) == 1
    with pytest.raises(ValueError, match="Expected a table among"):
        clinic.add_link("nope", "a", "visit", "patient_id")
    with pytest.raises(ValueError, match="Expected a method among"):
        clinic.add_link("patient", "p_id", "visit", "patient_id", "nope")


def test_run_linked_tables(clinic):
    parameters = ParameterSet().set("patient", k=5, ncp=3).set("visit", k=5, ncp=3)
    out = run(clinic, parameters, multi_table_metrics=False, stages=["signal_metrics"])
    patients, visits = out.shuffled("patient"), out.shuffled("visit")
    assert (patients.count(), visits.count()) == (130, 300)
    lost = visits.join(patients, visits["patient_id"] == patients["p_id"], "left_anti")
    assert lost.count() == 0
    metrics = {(r["metric"], r["computation_type"]) for r in out.signal_metrics("patient").collect()}
    assert ("hellinger_mean", "standalone") in metrics
    assert out.run["meta_signal_metric"].where("metric = 'hellinger_mean'").count() == 1


def test_run_on_a_given_pair(iris, spark):
    twin = iris.withColumn("sepal_length", F.col("sepal_length") + 0.01)
    dataset = DatasetSpec("d").add_table("iris", iris, synthetic_data=twin, primary_key="id")
    parameters = ParameterSet().set("iris", ncp=2, known_variables=["sepal_length"], target="variety",
                                    categorical_hidden_rate_variables=["variety"])
    out = run(dataset, parameters)
    got = {r["metric"]: r["value"] for r in out.privacy_metrics("iris").collect()}
    assert got["column_direct_match_protection"] == 0.0
    assert got["row_direct_match_protection"] > 90.0
    assert {"hidden_rate", "local_cloaking", "inference_categorical", "correlation_protection_rate",
            "categorical_hidden_rate", "closest_rate", "nndr"} <= set(got)


def test_run_private(iris):
    dataset = DatasetSpec("d").add_table("iris", iris, primary_key="id")
    parameters = ParameterSet().set(
        "iris", dp_epsilon=5.0, dp_bounds={"sepal_length": (4.0, 8.0), "sepal_width": (1.0, 5.0)},
        dp_modalities={"variety": ["Setosa", "Versicolor", "Virginica"]}, ncp=2)
    with pytest.raises(ValueError, match="Expected dp_bounds or dp_modalities for petal_length, petal_width"):
        run(dataset, parameters, stages=["synthesis"])
    parameters = parameters.update("iris", exclude_variable_names=["petal_length", "petal_width"])
    out = run(dataset, parameters.update("iris", dp_missing=["sepal_width"]), stages=["synthesis"])
    assert out.shuffled("iris").count() == 150
    assert 0 < out.unshuffled("iris").where("sepal_width is null").count() < 150
    spent = out.get("iris", "privacy_budget")
    assert spent.agg(F.sum("epsilon")).first()[0] == pytest.approx(5.0)
    assert {r["step"] for r in spent.where("column = 'sepal_width'").collect()} == {"sum", "count", "gap", "value"}
    assert out.run["run_metadata"].first()["table_name"] == "iris"


def test_run_attaches_figures(iris):
    dataset = DatasetSpec("d").add_table("iris", iris, primary_key="id")
    out = run(dataset, ParameterSet().set("iris", k=5, ncp=2), stages=["synthesis"])
    assert out.get("iris", "figures_projections").count() == 300
    rho = {(r["a"], r["b"]): r["rho"] for r in out.get("iris", "figures_correlations").where("side = 'original'").collect()}
    assert len(rho) == 16 and rho["sepal_length", "sepal_length"] == pytest.approx(1.0)
    shares = out.get("iris", "figures_distributions").groupBy("column").agg(F.sum("original")).collect()
    assert all(r[1] == pytest.approx(1.0) for r in shares) and len(shares) == 5
    assert {r["component"] for r in out.get("iris", "figures_contributions").collect()} == {1, 2}
    assert out.get("iris", "figures_aggregate_stats").count() == 8
    assert out.get("iris", "advice").first()["k"] >= 1


def test_hidden_rate_of_individuals(spark):
    def points(rows):
        return spark.createDataFrame(rows, "id long, features array<double>")

    originals = points([(1, [0.0]), (2, [10.0]), (3, [20.0]), (4, [30.0]), (5, [40.0])])
    made = points([(1, [9.0]), (2, [1.0]), (3, [29.0]), (4, [50.0]), (5, [21.0])])
    owners = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "c"), (5, None)], "id long, individual_id string")
    # 1 -> 2 and 2 -> 1 are rows of the same person; 3 -> 5 of nobody known; 4 -> 3 of another
    assert privacy.hidden_rate(originals, made, "id") == 100.0
    assert privacy.hidden_individuals_rate(originals, made, "id", owners) == pytest.approx(200 / 3)


def test_synthetic_rows_are_filled_as_the_originals_were(spark):
    rng = np.random.default_rng(17)
    rows = [(i, None if i % 5 == 0 else float(i % 50), float(i % 50) + rng.normal() / 10) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    made = synthesize(df, "id", k=4, ncp=2, imputation_method="knn", imputation_k=3)
    filled = complete(df, made).orderBy("id").toPandas()
    own = made.prepared.orderBy("id").toPandas()
    assert filled["x"].to_numpy() == pytest.approx(own["x"].to_numpy())
    assert (filled["x"] - [r[2] for r in rows]).abs().max() < 5


def test_private_rows_keep_means_and_gaps(spark):
    df = spark.range(3000).selectExpr(
        "id", "case when id % 4 = 0 then null else 50.0D end as x", "case when id % 5 = 0 then null else 'a' end as c")
    settings = dict(epsilon=40.0, bounds={"x": (0.0, 100.0)}, modalities={"c": ["a", "b"]})
    plain = private_rows(df, "id", **settings).agg(F.avg("x"), F.count("x"), F.min("x")).first()
    assert plain[0] == pytest.approx(50.0, abs=3) and plain[1] == 3000
    gaps = private_rows(df, "id", **settings, missing=["x", "c"]).agg(F.count("x"), F.count("c")).first()
    assert gaps[0] == pytest.approx(2250, abs=60) and gaps[1] == pytest.approx(2400, abs=60)


def test_run_series(spark):
    events = spark.read.parquet(f"{SMALL}/events.parquet").select("event_id", "user_id", "ts", "value")
    users = events.groupBy("user_id").agg(F.avg("value").alias("mean"), F.count(F.lit(1)).alias("n"))
    dataset = (
        DatasetSpec("s").add_table("user", users, primary_key="user_id", individual_level=True)
        .add_table("events", events, primary_key="event_id", foreign_keys=("user_id",), time_series_time="ts")
        .add_link("user", "user_id", "events", "user_id", "time_series")
    )
    parameters = ParameterSet().set("user", k=3, ncp=3).set(
        "events", time_series_nb_points=8, time_series_method="specified", time_series_nf=2)
    out = run(dataset, parameters, stages=["synthesis"])
    series = out.unshuffled("events")
    assert series.count() == users.count() * 8
    assert dict(series.dtypes)["ts"] == "timestamp_ntz"
    assert out.shuffled("user").count() == users.count()


def test_run_two_series_with_all_columns_and_metrics(spark):
    users = spark.range(40).selectExpr("id as user_id", "cast(id % 7 as double) as x")
    records = users.selectExpr("user_id", "explode(sequence(0, 5)) as n")
    one = records.selectExpr("user_id * 10 + n as pk", "user_id", "cast(n as double) as t",
                             "sin(n) + user_id as v", "cos(n) as w", "if(n > 2, 'late', 'early') as note")
    two = records.selectExpr("user_id * 10 + n as pk", "user_id", "cast(n * n as double) as t", "n * 1.0D as u")
    dataset = (
        DatasetSpec("s").add_table("user", users, primary_key="user_id", individual_level=True)
        .add_table("one", one, primary_key="pk", foreign_keys=("user_id",), time_series_time="t")
        .add_table("two", two, primary_key="pk", foreign_keys=("user_id",), time_series_time="t")
        .add_link("user", "user_id", "one", "user_id", "time_series")
        .add_link("user", "user_id", "two", "user_id", "time_series")
    )
    parameters = ParameterSet().set("user", k=3, ncp=3)
    for name in ("one", "two"):
        parameters = parameters.set(name, time_series_nb_points=4, time_series_method="specified", time_series_nf=2)
    out = run(dataset, parameters, multi_table_metrics=False)
    rows = out.unshuffled("one")
    assert rows.columns == ["pk", "user_id", "t", "v", "w", "note", "point"]
    assert rows.count() == rows.select("pk").distinct().count() == 160
    assert {r["note"] for r in rows.collect()} <= {"late", "early"}
    assert out.unshuffled("two").count() == 160
    for name in ("one", "two"):
        assert "hellinger_mean" in {r["metric"] for r in out.signal_metrics(name).collect()}
        assert {"hidden_rate", "local_cloaking", "nndr"} <= {r["metric"] for r in out.privacy_metrics(name).collect()}


def test_advice(clinic):
    got = advise_parameters(clinic, ParameterSet(), "patient").get("patient")
    assert (got.k, got.ncp, got.use_categorical_reduction) == (6, 5, False)


def test_streaming(spark, tmp_path):
    source = spark.read.parquet(f"{SMALL}/events.parquet").select("event_id", "ts", "value")
    chain = Pipeline([DatetimeProcessor(), ProportionProcessor(["value"], "event_id", sum_to_one=False)]).fit(source)
    stream = spark.readStream.schema(source.schema).parquet(f"{SMALL}/events*.parquet")
    query = (
        preprocess_stream(chain, stream).writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination(120)
    got, want = spark.read.parquet(str(tmp_path / "out")), chain.preprocess(source)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    blocked = InterRecordCumulatedDifferenceProcessor("user_id", "value", "f", "d", "event_id")
    with pytest.raises(ValueError, match="cannot run on a stream"):
        preprocess_stream(blocked, stream)


def test_sparse_space_equals_the_dense_one(spark):
    rng = np.random.default_rng(21)
    n = 400
    g = rng.integers(0, 4, n)
    df = spark.createDataFrame(
        [(i, float(g[i] + rng.normal() / 3), float(rng.normal()), f"a{g[i]}" if rng.random() < 0.9 else "b'x",
          f"c{(g[i] + rng.integers(0, 2)) % 4}", "same") for i in range(n)],
        "id long, x double, z double, p string, q string, r string")
    columns = ["x", "p", "z", "q", "r"]
    dense = fit_space(df, columns, row_key="id", ncp=3, weights={"p": 2.0})
    sparse = fit_sparse_space(df, columns, row_key="id", ncp=3, weights={"p": 2.0}, passes=12)
    a, b = (np.stack(s.place(df, "id").orderBy("id").toPandas()["features"].to_numpy()) for s in (dense, sparse))
    assert sparse.explained == pytest.approx(a.var(axis=0), rel=1e-6)
    for j in range(3):
        assert abs(abs(np.corrcoef(a[:, j], b[:, j])[0, 1]) - 1) < 1e-6
        assert b[:, j].var() == pytest.approx(a[:, j].var(), rel=1e-6)


def test_a_column_of_names_is_projected(spark):
    rows = [(i, f"name {i // 2}", f"g{i % 3}", float(i % 3)) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, name string, g string, x double")
    space = fit_sparse_space(df, ["name", "g", "x"], row_key="id", ncp=2, passes=3)
    out = np.stack(space.place(df, "id").orderBy("id").toPandas()["features"].to_numpy())
    assert np.abs(out.mean(axis=0)).max() < 1e-9 and abs(np.cov(out.T)[0, 1]) < 1e-6
    assert out.var(axis=0) == pytest.approx(space.explained) and space.explained[0] >= space.explained[1] > 0
    new = spark.createDataFrame([(1, "nobody", "g1", 1.0)], "id long, name string, g string, x double")
    assert len(space.place(new, "id").first()["features"]) == 2


@pytest.mark.parametrize("projection", ["flatten", "fpca"])
def test_series_components_against_numpy(spark, projection):
    rng = np.random.default_rng(31)
    n, points = 60, 30
    t = np.linspace(0, 1, points)
    a = rng.normal(size=(n, 1)) * np.sin(3 * t) + rng.normal(size=(n, 1)) * t**2 + 0.01 * rng.normal(size=(n, points)) + 5
    b = 0.3 * rng.normal(size=(n, 1)) * np.cos(2 * t) + 0.01 * rng.normal(size=(n, points))
    rows = [(i, j, float(a[i, j]), float(b[i, j])) for i in range(n) for j in range(points)]
    aligned = spark.createDataFrame(rows, "id long, point int, a double, b double")
    scores, made = ts.series_scores(aligned, "id", ["a", "b"], points, projection=projection, nf=3)
    weight = np.ones(points) if projection == "flatten" else np.sqrt(np.where((t == 0) | (t == 1), 0.5, 1) / (points - 1))
    whole = np.stack([a * weight, b * weight], axis=2).reshape(n, -1)
    u, s, v = np.linalg.svd(whole - whole.mean(axis=0), full_matrices=False)
    v = v * np.sign(v[np.arange(len(v)), np.abs(v).argmax(axis=1)])[:, None]
    want = (whole - whole.mean(axis=0)) @ v[:3].T
    got = np.stack(scores.orderBy("id").toPandas()["features"].to_numpy())
    assert got == pytest.approx(want, abs=1e-6)
    assert made.explained == pytest.approx(s[:3] ** 2 / n, rel=1e-6)
