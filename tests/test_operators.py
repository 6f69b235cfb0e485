"""Rounding, profiles, splits, sources and relational helpers."""

from __future__ import annotations

import math
from datetime import datetime

import numpy as np
import pytest
from conftest import FIXTURES, rows_of
from pyspark.sql import functions as F

from maskloom.functions.rounding import saferound_columns, saferound_groups
from maskloom.functions.uniform import discrete_laplace, fine, laplace, uniform
from maskloom.functions.validation import nan_to_null, reject_minus_infinity, same_keys
from maskloom.operators.histogram import histogram
from maskloom.operators.profile import (
    distinct_counts,
    infer_types,
    modality_counts,
    numeric_under_threshold,
    split_columns_types,
)
from maskloom.operators.relational import (
    downsample_series,
    order_by_categories,
    sample_with_replacement,
    shuffled,
    value_count_difference,
)
from maskloom.operators.scan import scan
from maskloom.operators.split import batch_parts, first_occurrences
from maskloom.sources.results import RunResult, read_records, write_records
from maskloom.sources.tables import read_csv, read_table, write_csv

ITEMS = [2.347, 11.062, 0.914, 7.381, 15.655, 8.218]


def safe(spark, values, places, strategy="difference", topline=None):
    names = [f"c{i}" for i in range(len(values))]
    df = spark.createDataFrame([tuple(values)], ", ".join(f"{n} double" for n in names))
    if topline is not None:
        df = df.withColumn("top", F.lit(float(topline)))
    out = saferound_columns(df, names, places, strategy=strategy, topline="top" if topline is not None else None)
    return [out.first()[n] for n in names]


def plain_rounding(values, places, strategy, topline=None):
    """Round each value, then move those first in order by one unit until the total is right."""
    unit = 10.0**-places
    half_up = lambda x: math.copysign(math.floor(abs(x) / unit + 0.5) * unit, x)
    out = [half_up(v) for v in values]
    n = round(((half_up(sum(values)) if topline is None else topline) - sum(out)) / unit)
    sign = (n > 0) - (n < 0)
    place = {"difference": lambda i: round((out[i] - values[i]) * sign, 12), "largest": lambda i: -out[i],
             "smallest": lambda i: out[i]}[strategy]
    order = sorted(range(len(out)), key=lambda i: (place(i), i))
    for k in range(abs(n)):
        out[order[k % len(order)]] += sign * unit
    return out


@pytest.mark.parametrize("strategy", ["difference", "largest", "smallest"])
@pytest.mark.parametrize("places, scale", [(2, 1.0), (0, 1.0), (-1, 40.0), (-3, 9000.0), (1, -1.0), (-2, 1.0)])
def test_saferound_matches_a_plain_loop(spark, strategy, places, scale):
    values = [x * scale for x in ITEMS]
    got = safe(spark, values, places, strategy)
    assert got == pytest.approx(plain_rounding(values, places, strategy), abs=1e-6)


@pytest.mark.parametrize("topline", [44, 45, 46, 48])
def test_saferound_meets_the_topline(spark, topline):
    got = safe(spark, ITEMS, 0, topline=topline)
    assert sum(got) == topline
    assert got == plain_rounding(ITEMS, 0, "difference", topline)


def test_saferound_bad_strategy(spark):
    with pytest.raises(ValueError, match="valid RoundingStrategy"):
        safe(spark, ITEMS, 2, "bad")


def test_saferound_no_columns(make):
    df = make("a double", a=[1.5])
    assert saferound_columns(df, [], 0) is df


@pytest.mark.parametrize("limit", [10**6, 15])
def test_saferound_groups_keep_totals(make, limit):
    values = [(i * 37 % 101) / 7 for i in range(120)]
    groups = [0 if i % 3 else i % 5 for i in range(120)]
    df = make("g bigint, v double", g=groups, v=values)
    out = saferound_groups(df, ["g"], "v", "k", 1, max_group_rows=limit)
    for r in out.groupBy("g").agg(F.sum("v").alias("v"), F.sum("rounded").alias("r")).collect():
        assert r["r"] == pytest.approx(round(r["v"], 1), abs=1e-6)
    moved = out.agg(F.max(F.abs(F.col("v") - F.col("rounded"))).alias("m")).first()["m"]
    assert moved <= 0.1 + 1e-9


# -- types and profiles ------------------------------------------------------------------------

@pytest.fixture
def many(make):
    return make(
        "ints int, floats double, strings string, datetimes timestamp_ntz",
        ints=[7, 1, -30], floats=[0.25, 19.5, -6.0], strings=["ash", "elm", "fir"],
        datetimes=[datetime(2010, 6, 5, 4)] * 3,
    ).drop("k")


def test_types(many):
    assert infer_types(many) == {
        "ints": "int", "floats": "numeric", "strings": "category", "datetimes": "datetime"}
    assert infer_types(many, {"ints": "category"})["ints"] == "category"
    instants = many.select(F.col("datetimes").cast("timestamp").alias("t"), F.lit(True).alias("b"))
    assert infer_types(instants) == {"t": "datetime_tz", "b": "bool"}
    with pytest.raises(ValueError, match="Expected logical types"):
        infer_types(many, {"ints": "nope"})


def test_split_types(many):
    assert split_columns_types(many) == ([0, 1], [2, 3])
    assert split_columns_types(many.select("ints", "floats")) == ([0, 1], [])
    assert split_columns_types(many.select("strings", "datetimes")) == ([], [0, 1])
    for kind in ("tinyint", "smallint", "bigint", "float"):
        assert split_columns_types(many.withColumn("ints", F.col("ints").cast(kind)))[0] == [0, 1]


def test_numeric_under_threshold(make, many):
    df = make("wheels bigint, price bigint", wheels=[4, 2, 4, 2], price=[30, 9, 31, 12])
    assert numeric_under_threshold(df.drop("k"), threshold=2) == ["wheels"]
    assert numeric_under_threshold(many, threshold=1) == ["datetimes"]


def test_modalities_ignore_nulls(make):
    df = make("a string, b string", a=["x", None, "x"], b=[None, None, None])
    got = {(r["column"], r["value"]): r["n"] for r in modality_counts(df, ["a", "b"]).collect()}
    assert got == {("a", "x"): 2}
    assert {r["column"]: r["n_unique"] for r in distinct_counts(df, ["a", "b"]).collect()} == {"a": 1, "b": 0}


def test_validation(make):
    df = make("a double", a=[1.0, float("nan"), None])
    assert rows_of(nan_to_null(df))["a"] == [1.0, None, None]
    reject_minus_infinity(df)
    with pytest.raises(ValueError, match="-inf"):
        reject_minus_infinity(make("a double", a=[float("-inf")]))
    assert same_keys(df, df, "k")
    assert not same_keys(df, df.where("k > 0"), "k")


# -- split -------------------------------------------------------------------------------------

def test_first_occurrences(make):
    colours, sizes = list("rgrbgyrb"), [7, 7, 9, 9, 7, 4, 9, 5]
    df = make("colour string, size bigint", colour=colours, size=sizes)
    seen, want = [set(), set()], []
    for k, values in enumerate(zip(colours, sizes)):
        if any(v not in s for v, s in zip(values, seen)):
            want.append(k)
        for v, s in zip(values, seen):
            s.add(v)
    assert sorted(r["k"] for r in first_occurrences(df, ["colour", "size"], "k").collect()) == want


def test_batch_parts(make):
    df = make("a string, b string, c string", a=list("abbaabbaabba"), b=list("ABBBABBBABBB"),
              c=list("121112111211"))
    out = rows_of(batch_parts(df, ["a", "b", "c"], "k", row_limit=6, seed=42))
    assert sorted(out["part"]) == [0] * 6 + [1] * 6
    assert out["part"][0] == 0 and out["part"][1] == 0
    df = make("a string", a=["x"] * 14)
    sizes = sorted(rows_of(batch_parts(df, ["a"], "k", row_limit=4))["part"])
    assert [sizes.count(i) for i in range(4)] == [4, 4, 3, 3]


def test_batch_parts_too_varied(make):
    df = make("a string", a=["x", "y", "z"])
    with pytest.raises(ValueError, match="You have too much variability in your categorical data"):
        batch_parts(df, ["a"], "k", row_limit=2)


# -- relational --------------------------------------------------------------------------------

def test_category_order(make):
    df = make("d string", d=["Friday", "Monday", "?", "Tuesday"])
    got = [r["d"] for r in order_by_categories(df, "d", ["Monday", "Tuesday", "Friday"], "d").collect()]
    assert got == ["Monday", "Tuesday", "Friday", "?"]


def test_value_count_difference(make):
    a, b = make("v string", v=["x", "x", "y"]), make("v string", v=["x", "z"])
    got = {r["v"]: r["difference"] for r in value_count_difference(a, b, "v").collect()}
    assert got == {"x": 1, "y": None, "z": None}


def test_shuffle_and_bootstrap(make):
    df = make("v bigint", v=list(range(400)))
    order = [r["k"] for r in shuffled(df, "k", 1).collect()]
    assert sorted(order) == list(range(400)) and order != sorted(order)
    copies = sample_with_replacement(df, "k", 1.0, 2).count()
    assert 320 < copies < 480


@pytest.mark.parametrize("proportion", [0.1, 0.34, 0.99, 1.0])
def test_downsample(make, proportion):
    ids = [0] * 23 + [1] * 7 + [2]
    df = make("id bigint, t bigint", id=ids, t=list(range(31)))
    out = downsample_series(df, "id", "t", "k", proportion).collect()
    for i, n, offset in ((0, 23, 0), (1, 7, 23), (2, 1, 30)):
        points = int(proportion * n)
        want = [] if points == 0 else [0] if points == 1 else [
            math.floor(j * ((n - 1) / (points - 1))) if j < points - 1 else n - 1 for j in range(points)]
        assert sorted(r["k"] - offset for r in out if r["id"] == i) == want


def test_histogram_edges(make):
    values = [0.0, 0.1, 0.2, 0.3, 0.6, 0.7, 0.9999, 1.0]
    counts, edges = np.histogram(values, bins=10)
    got = {r["bin"]: r for r in histogram(make("v double", v=values), "v", 10).collect()}
    assert {b: r["n"] for b, r in got.items()} == {i: n for i, n in enumerate(counts) if n}
    assert all(r["lower"] == edges[b] and r["upper"] == edges[b + 1] for b, r in got.items())


def test_uniform_and_laplace(spark):
    df = spark.range(4000)
    row = df.agg(F.avg(uniform(1, "s", "id")), F.avg(laplace(2.0, 1, "s", "id")),
                 F.avg(F.abs(laplace(2.0, 1, "s", "id")))).first()
    assert row[0] == pytest.approx(0.5, abs=0.02)
    assert row[1] == pytest.approx(0.0, abs=0.15) and row[2] == pytest.approx(2.0, abs=0.15)


def test_discrete_noise(spark):
    df = spark.range(20_000)
    u = df.select(fine(3, "s", "id").alias("u")).toPandas()["u"].to_numpy()
    assert 0 <= u.min() and u.max() < 1 and u.mean() == pytest.approx(0.5, abs=0.01)
    assert len({int(v * 2**53) % 2 for v in u}) == 2  # the last bit is drawn too
    assert -math.log(1 - (2**53 - 1) / 2**53) > 25  # so far, in scales, reach the draws
    scale, grid = 3.0, 2.0
    n = df.select(discrete_laplace(scale, grid, 3, "n", "id").alias("n")).toPandas()["n"].to_numpy()
    assert set(np.mod(n, grid)) == {0.0}
    q = math.exp(-grid / scale)
    for k in (-2, -1, 0, 1, 2):
        assert (n == k * grid).mean() == pytest.approx((1 - q) / (1 + q) * q ** abs(k), abs=0.012)


# -- sources -----------------------------------------------------------------------------------

def test_csv_round_trip(spark, tmp_path):
    df = read_table(spark, f"{FIXTURES}/iris.csv")
    assert df.count() == 150 and dict(df.dtypes)["sepal.length"] == "double"
    write_csv(df, str(tmp_path / "out.csv"))
    again = read_csv(spark, str(tmp_path / "out.csv"), df.schema)
    assert again.exceptAll(df).count() == 0 and again.count() == 150


def test_table_from_frame_and_bad_suffix(spark, make):
    df = make("a double", a=[1.0, float("nan")])
    assert rows_of(read_table(spark, df))["a"] == [1.0, None]
    with pytest.raises(ValueError, match="Expected a .csv or .parquet path"):
        read_table(spark, "x.unknown")


def test_records(spark, make, tmp_path):
    df = make("metric string, value double", metric=["a", "b"], value=[1.0, 2.0])
    write_records(df, str(tmp_path / "lines"))
    assert read_records(spark, str(tmp_path / "lines")).count() == 2
    (tmp_path / "one.json").write_text('{"hidden_rate": 3.5,\n "metadata": {"table_name": "t"}}')
    assert read_records(spark, str(tmp_path / "one.json")).first()["hidden_rate"] == 3.5
    (tmp_path / "many.json").write_text('[{"a": 1}, {"a": 2}]')
    assert read_records(spark, str(tmp_path / "many.json")).count() == 2


def test_run_result_catalogue(spark, make, tmp_path):
    rows = make("a bigint", a=[1, 2])
    metrics = spark.createDataFrame(
        [("t", "standalone", None, "hidden_rate", 50.0)],
        "table_name string, computation_type string, reference string, metric string, value double")
    result = RunResult({"t": {"shuffled": rows, "privacy_metrics": metrics}})
    result.write(str(tmp_path / "run"))
    back = RunResult.read(spark, str(tmp_path / "run"), {"t": ["shuffled", "privacy_metrics"]})
    assert back.shuffled("t").count() == 2
    assert back.privacy_metrics("t").first()["value"] == 50.0
    with pytest.raises(ValueError, match="has no result"):
        back.signal_metrics("t")


def test_split_scan_carries_sums_over_nulls(spark):
    df = spark.range(400).selectExpr(
        "id", "'g' as g", "case when id < 30 or id % 90 between 20 and 70 then null else id end as v")
    whole = scan(df, ["g"], ["id"], cumsum={"s": "v"})
    cut = scan(df, ["g"], ["id"], cumsum={"s": "v"}, max_group_rows=40)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, cut.collect()))


def test_group_rounding_keeps_rows_without_value(spark, make):
    df = make("g string, v double", g=["a", "a", "a"], v=[1.4, None, 1.4])
    got = rows_of(saferound_groups(df, ["g"], "v", "k", 0))["rounded"]
    assert got[1] is None and got[0] + got[2] == 3.0


def test_bootstrap_copies_have_no_upper_end(spark):
    for rate in (60.0, 3.0):
        n = sample_with_replacement(spark.range(2000), "id", rate, seed=1).count()
        assert n / 2000 == pytest.approx(rate, rel=0.03)


def test_intermediate_tables_can_be_dropped(spark, monkeypatch, tmp_path):
    from maskloom import session

    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    assert session.materialize(spark.range(5)).count() == 5
    assert len(list((tmp_path / session.RUN).iterdir())) == 1
    assert session.drop_intermediate(spark) and not (tmp_path / session.RUN).exists()
    assert not session.drop_intermediate(spark)
