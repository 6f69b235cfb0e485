"""Every processor, forward and backward, against plain loops over small own tables."""

from __future__ import annotations

from datetime import date, datetime
from statistics import mean, stdev

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from maskloom.operators.processors import (
    DatetimeProcessor,
    ExpectedMeanProcessor,
    GeolocationNormalizationProcessor,
    GroupModalitiesProcessor,
    InterRecordBoundedCumulatedDifferenceProcessor,
    InterRecordBoundedRangeDifferenceProcessor,
    InterRecordCumulatedDifferenceProcessor,
    InterRecordRangeDifferenceProcessor,
    PerturbationProcessor,
    Processor,
    ProportionProcessor,
    RelativeDifferenceProcessor,
    ToCategoricalProcessor,
)

near = pytest.approx


def test_protocol():
    assert isinstance(DatetimeProcessor(), Processor)


# -- datetime ----------------------------------------------------------------------------------

EPOCH = datetime(1970, 1, 1)


def test_datetime_round_trip(make):
    times, days = [datetime(2003, 7, 19, 4, 30), datetime(1999, 2, 28, 23, 59, 59, 125000), None], [
        date(2011, 11, 11), date(1966, 3, 5), None]
    df = make("a timestamp_ntz, b date, c bigint", a=times, b=days, c=[4, 5, 6])
    model = DatetimeProcessor().fit(df)
    out = rows_of(model.preprocess(df))
    assert out["a"] == [t and (t - EPOCH).total_seconds() for t in times]
    assert out["b"] == [d and (d - EPOCH.date()).days * 86400.0 for d in days]
    back = rows_of(model.postprocess(df, model.preprocess(df)))
    assert back == rows_of(df)


def test_datetime_post_of_synthetic_seconds(make):
    source = make("d timestamp_ntz", d=[datetime(2003, 7, 19)])
    dest = make("d double", d=[86400.0 * 365 + 61])
    out = rows_of(DatetimeProcessor().fit(source).postprocess(source, dest))
    assert out["d"] == [datetime(1971, 1, 1, 0, 1, 1)]


def test_instants_with_time_zone(make):
    df = make("d timestamp", d=[datetime(2021, 10, 3, 2, 15, 44)])
    model = DatetimeProcessor().fit(df)
    assert rows_of(model.postprocess(df, model.preprocess(df))) == rows_of(df)


# -- to categorical ----------------------------------------------------------------------------

@pytest.fixture
def parcels(make):
    return make(
        "weight double, grade double",
        weight=[0.5, 4.25, 8.0, 2.5, None, 6.75], grade=[7.0, 9.0, 7.0, 9.0, None, 9.0],
    )


@pytest.mark.parametrize("keep", [True, False])
def test_to_categorical_round_trip(parcels, keep):
    model = ToCategoricalProcessor(2, keep_continuous=keep).fit(parcels.drop("k"))
    encoded = model.preprocess(parcels)
    assert model.variables == ("grade",)
    assert dict(encoded.dtypes)["grade"] == "string"
    assert ("grade__cont" in encoded.columns) is keep
    back = model.postprocess(parcels, encoded)
    assert back.dtypes == parcels.dtypes
    assert rows_of(back) == rows_of(parcels)


def test_to_categorical_other_takes_the_number(make, parcels):
    model = ToCategoricalProcessor(2, keep_continuous=True).fit(parcels.drop("k"))
    dest = make("weight double, grade string, grade__cont double",
                weight=[1.0, 2.0, 3.0], grade=["other", "9.0", "other"], grade__cont=[8.5, 8.0, None])
    assert rows_of(model.postprocess(parcels, dest))["grade"] == [8.5, 9.0, None]


# -- group modalities --------------------------------------------------------------------------

TOWNS = ["oslo"] * 5 + ["bern"] * 3 + ["rome"] * 2 + ["lima", "kiev"]


@pytest.fixture
def towns(make):
    return make("town string, side string", town=TOWNS, side=["left", "right"] * 6)


def grouped(values, most, name="other"):
    """A value held by ``most`` rows or fewer becomes ``name``."""
    return [name if v is not None and values.count(v) <= most else v for v in values]


@pytest.mark.parametrize("name", ["other", "sonstige"])
def test_group_modalities_generic(towns, name):
    processor = GroupModalitiesProcessor(min_unique=3, global_threshold=2, new_category=name)
    out = rows_of(processor.fit(towns.drop("k")).preprocess(towns))
    assert out["town"] == grouped(TOWNS, 2, name)
    assert out["side"] == ["left", "right"] * 6


def test_group_modalities_per_column(towns):
    model = GroupModalitiesProcessor(variable_thresholds={"town": 3, "side": 6}).fit(towns)
    out = model.preprocess(towns)
    assert rows_of(out)["town"] == grouped(TOWNS, 3)
    assert rows_of(out)["side"] == ["other"] * 12
    assert model.postprocess(towns, out) is out


def test_group_modalities_no_column_qualifies(towns):
    model = GroupModalitiesProcessor(min_unique=9, global_threshold=1).fit(towns)
    assert rows_of(model.preprocess(towns)) == rows_of(towns)


def test_group_modalities_keeps_nulls(make):
    values = ["up", None, "down", None, "down", "down"]
    df = make("v string", v=values)
    model = GroupModalitiesProcessor(variable_thresholds={"v": 1}).fit(df)
    assert rows_of(model.preprocess(df))["v"] == grouped(values, 1)


# fixed values: texts that callers match on
@pytest.mark.parametrize("kwargs, text", [
    ({"min_unique": 4}, "Expected both of \\(global_threshold, min_unique\\)"),
    ({"global_threshold": 4}, "Expected both of \\(global_threshold, min_unique\\)"),
    ({}, "Expected variable_thresholds or \\(threshold, min_unique\\)"),
    ({"variable_thresholds": {"town": 2}, "min_unique": 4, "global_threshold": 4},
     "Expected variable_thresholds or \\(threshold, min_unique\\)"),
])
def test_group_modalities_arguments(kwargs, text):
    with pytest.raises(ValueError, match=text):
        GroupModalitiesProcessor(**kwargs)


def test_group_modalities_unknown_column(towns):
    with pytest.raises(ValueError, match="Expected valid variables in variable_thresholds"):
        GroupModalitiesProcessor(variable_thresholds={"street": 3}).fit(towns)


# -- perturbation ------------------------------------------------------------------------------

def test_perturbation_numeric(make):
    source, dest = make("c double", c=[4.0, -2.0, 8.0]), make("c double", c=[8.0, 2.0, 8.0])
    model = PerturbationProcessor("k", {"c": 0.25}, seed=1).fit(source)
    assert rows_of(model.postprocess(source, dest))["c"] == [5.0, -1.0, 8.0]


def test_perturbation_keeps_rows_without_source(make):
    source, dest = make("c double", c=[4.0]), make("c double", c=[8.0, 6.0])
    model = PerturbationProcessor("k", {"c": 0.5}, seed=1).fit(source)
    assert rows_of(model.postprocess(source, dest))["c"] == [6.0, 6.0]


@pytest.mark.parametrize("level", [0.0, 0.25, 0.8])
def test_perturbation_categories_follow_the_level(make, level):
    n = 2000
    source, dest = make("c string", c=["s"] * n), make("c string", c=["d"] * n)
    model = PerturbationProcessor("k", {"c": level}, seed=3).fit(source)
    taken = rows_of(model.postprocess(source, dest))["c"].count("d") / n
    assert abs(taken - level) < 0.05


def test_perturbation_unknown_column(make):
    df = make("c double", c=[2.0])
    with pytest.raises(ValueError, match="perturbation_level"):
        PerturbationProcessor("k", {"other": 0.6}).fit(df).postprocess(df, df)


def test_perturbation_level_one_is_free(make):
    df = make("c double", c=[2.0])
    assert PerturbationProcessor("k", {"c": 1.0}).fit(df).postprocess(df, df) is df


# -- proportions -------------------------------------------------------------------------------

PARTS = {"rent": [400.0, 90.0, 7.0, None], "food": [100.0, 210.0, 7.0, None], "rest": [300.0, 0.0, 14.0, None]}


@pytest.fixture
def budgets(make):
    return make("income bigint, rent double, food double, rest double, saved double",
                income=[800, 300, 28, 50], **PARTS, saved=[200.0, 75.0, 0.0, None])


def test_proportions(budgets):
    model = ProportionProcessor(list(PARTS), "income").fit(budgets)
    out = model.preprocess(budgets)
    assert out.columns == budgets.columns
    got, income = rows_of(out), [800, 300, 28, 50]
    for c, values in PARTS.items():
        assert got[c] == [None if v is None else near(v / i) for v, i in zip(values, income)]
    back = rows_of(model.postprocess(budgets, out))
    assert {c: back[c] for c in PARTS} == PARTS


def test_proportion_of_reference(budgets):
    model = ProportionProcessor(["saved"], "income", sum_to_one=False).fit(budgets)
    out = model.preprocess(budgets)
    assert rows_of(out)["saved"] == [0.25, 0.25, 0.0, None]
    assert rows_of(model.postprocess(budgets, out))["saved"] == [200.0, 75.0, 0.0, None]


def test_proportion_zeros(make):
    df = make("all bigint, a bigint, b bigint", all=[40, 25], a=[30, 0], b=[10, 0])
    out = rows_of(ProportionProcessor(["a", "b"], "all").fit(df).preprocess(df))
    assert out["a"] == [0.75, 0.0] and out["b"] == [0.25, 0.0]


@pytest.mark.parametrize("decimals", [0, 2])
def test_proportion_sum_is_kept(make, decimals):
    total, share = [77, 250, 13], [0.41, 0.125, 0.9]
    dest = make("all bigint, a double, b double", all=total, a=share, b=[1 - x for x in share])
    model = ProportionProcessor(["a", "b"], "all", decimal_count=decimals).fit(dest)
    out = rows_of(model.postprocess(dest, dest))
    assert [a + b for a, b in zip(out["a"], out["b"])] == near(total)
    assert out["a"] == near([t * x for t, x in zip(total, share)], abs=10.0**-decimals)


def test_proportion_post_example(make):
    dest = make("all bigint, a double, b double", all=[50, 30], a=[0.2, 0.9], b=[0.6, 0.3])
    out = rows_of(ProportionProcessor(["a", "b"], "all").fit(dest).postprocess(dest, dest))
    assert out["a"] == [12.5, 22.5] and out["b"] == [37.5, 7.5]


def test_proportion_unknown_reference(budgets):
    model = ProportionProcessor(["rent"], "salary").fit(budgets)
    for call in (lambda: model.preprocess(budgets), lambda: model.postprocess(budgets, budgets)):
        with pytest.raises(ValueError, match="variable_name"):
            call()


# -- relative difference -----------------------------------------------------------------------

LEVELS = {"low": [3, 11, 40, 8], "mid": [5, 16, 61, 8], "high": [12, 27, 100, 30]}


@pytest.fixture
def levels(make):
    return make("low bigint, mid bigint, high bigint, gap double", **LEVELS, gap=[1.5, None, 2.0, 0.0])


def test_relative_difference(levels):
    one = RelativeDifferenceProcessor("mid", ["low"]).fit(levels)
    assert rows_of(one.preprocess(levels))["mid"] == [m - x for m, x in zip(LEVELS["mid"], LEVELS["low"])]
    two = RelativeDifferenceProcessor("high", ["low", "mid"]).fit(levels)
    out = two.preprocess(levels)
    assert rows_of(out)["high"] == [h - x - m for h, x, m in zip(LEVELS["high"], LEVELS["low"], LEVELS["mid"])]
    assert rows_of(two.postprocess(levels, out)) == rows_of(levels)


def test_relative_difference_rename_and_unit(levels):
    model = RelativeDifferenceProcessor("mid", ["low"], 4, "rise", drop_original_target=True).fit(levels)
    out = model.preprocess(levels)
    assert "mid" not in out.columns
    assert rows_of(out)["rise"] == [(m - x) / 4 for m, x in zip(LEVELS["mid"], LEVELS["low"])]
    back = rows_of(model.postprocess(levels, out))
    assert back["mid"] == LEVELS["mid"] and "rise" in back


def test_relative_difference_errors(levels):
    with pytest.raises(ValueError, match="Expected drop_original_target to be False"):
        RelativeDifferenceProcessor("mid", ["low"], drop_original_target=True)
    with pytest.raises(ValueError, match="Expected no missing values for `references`"):
        RelativeDifferenceProcessor("high", ["gap"]).preprocess(levels)
    bad = RelativeDifferenceProcessor("high", ["absent"])
    for call in (lambda: bad.preprocess(levels), lambda: bad.postprocess(levels, levels)):
        with pytest.raises(ValueError, match="Expected all reference variables in dataset columns"):
            call()


# -- expected mean -----------------------------------------------------------------------------

WARDS = ["n"] * 4 + ["s"] * 5
SOURCE = {"pulse": [61, 64, 70, 73, 80, 81, 88, 90, 95], "days": [2, 2, 5, 9, 1, 4, 4, 8, 12]}
DEST = {"pulse": [66, 70, 71, 75, 70, 79, 85, 99, 104], "days": [3, 5, 6, 11, 2, 3, 5, 9, 20]}


def ward(make, values):
    return make("ward string, pulse bigint, days bigint", ward=WARDS, **values)


def moved(column, source, dest, groups, scaled):
    """Each group of ``dest`` moved to the mean (and spread) of the group in ``source``."""
    out = []
    for g, x in zip(groups, dest[column]):
        own = [v for v, h in zip(dest[column], groups) if h == g]
        want = [v for v, h in zip(source[column], groups) if h == g]
        ratio = stdev(want) / stdev(own) if scaled else 1.0
        out.append((x - mean(own)) * ratio + mean(want))
    return out


@pytest.mark.parametrize("by, scaled", [(["ward"], False), (["ward"], True), (None, False), (None, True)])
def test_expected_mean(make, by, scaled):
    source, dest = ward(make, SOURCE), ward(make, DEST)
    model = ExpectedMeanProcessor(["pulse", "days"], groupby_variables=by, same_std=scaled).fit(source)
    assert model.preprocess(source).columns == source.columns
    out = rows_of(model.postprocess(source, dest))
    for c in SOURCE:
        assert out[c] == near(moved(c, SOURCE, DEST, WARDS if by else ["all"] * 9, scaled), abs=1e-6)
    if by:
        stats = {r["ward"]: r for r in model.statistics.collect()}
        assert stats["n"]["pulsemean"] == near(mean(SOURCE["pulse"][:4]))
        assert stats["s"]["daysstd"] == near(stdev(SOURCE["days"][4:]))


def test_expected_mean_zero_std(make):
    flat = DEST | {"days": [4, 4, 4, 4, 2, 3, 5, 9, 20]}
    source, dest = ward(make, SOURCE), ward(make, flat)
    model = ExpectedMeanProcessor(["pulse", "days"], groupby_variables=["ward"], same_std=True).fit(source)
    with pytest.warns(UserWarning, match="std of 0"):
        out = rows_of(model.postprocess(source, dest))
    assert out["pulse"] == near(moved("pulse", SOURCE, flat, WARDS, True), abs=1e-6)
    assert out["days"] == near(moved("days", SOURCE, flat, WARDS, False), abs=1e-6)


# -- records -----------------------------------------------------------------------------------

OWNERS = [3, 8, 8, 3, 5, 8, 3, 5]
READINGS = [410, 95, 60, 402, 7, 88, 455, 7]


def by_owner(owners, order):
    """Row numbers of each owner in the given order of rows."""
    out = {}
    for i in order:
        out.setdefault(owners[i], []).append(i)
    return out


def cumulated(**kwargs):
    return InterRecordCumulatedDifferenceProcessor("id", "value", "first", "diff", "k", **kwargs)


def summed(owners, first, diffs):
    out, last = [], {}
    for owner, start, diff in zip(owners, first, diffs):
        last[owner] = last.get(owner, start) + diff
        out.append(last[owner])
    return out


def test_cumulated(make):
    df = make("id bigint, value bigint", id=OWNERS, value=READINGS)
    first, diff = [0] * 8, [0.0] * 8
    for rows in by_owner(OWNERS, sorted(range(8), key=lambda i: (READINGS[i], i))).values():
        for before, i in zip([rows[0], *rows], rows):
            first[i], diff[i] = READINGS[rows[0]], float(READINGS[i] - READINGS[before])
    model = cumulated(keep_record_order=True)
    out = model.preprocess(df)
    assert [c for c in out.columns if c != "k"] == ["id", "first", "diff"]
    got = rows_of(out)
    assert got["first"] == first and got["diff"] == diff
    assert rows_of(model.postprocess(df, out))["value"] == READINGS
    moved_rows = out.withColumn("k", F.col("k") + 10)
    assert rows_of(cumulated().postprocess(df, moved_rows))["value"] == summed(OWNERS, first, diff)
    with pytest.raises(ValueError, match="Expected `keep_record_order` to be `True` only if"):
        model.postprocess(df, moved_rows)


def test_cumulated_more_records(make):
    df = make("id bigint, value bigint", id=OWNERS, value=READINGS)
    owners, diffs = [5, 3, 5, 5, 3], [0, 4, 2, 11, 6]
    first = [7 if o == 5 else 402 for o in owners]
    dest = make("id bigint, first bigint, diff bigint", id=owners, first=first, diff=diffs)
    assert rows_of(cumulated().postprocess(df, dest))["value"] == summed(owners, first, diffs)


def test_cumulated_errors(make):
    df = make("id bigint, value bigint", id=[4, None], value=[6, 9])
    with pytest.raises(ValueError, match="Expected no missing values for id variable"):
        cumulated().preprocess(df)
    df = make("id bigint, value bigint", id=[4, 4], value=[6, None])
    with pytest.raises(ValueError, match="Expected no missing values for target variable"):
        cumulated().preprocess(df)
    with pytest.raises(ValueError, match="Expected a valid `id_variable`"):
        cumulated().preprocess(df.drop("id"))
    with pytest.raises(ValueError, match="Expected a valid `target_variable`"):
        cumulated().preprocess(df.drop("value"))
    good = make("id bigint, value bigint", id=[4], value=[6])
    dest = make("id bigint, first bigint, diff double", id=[4], first=[6], diff=[None])
    with pytest.raises(ValueError, match="target variable in source"):
        cumulated().postprocess(df, dest)
    with pytest.raises(ValueError, match="`new_difference_variable_name`"):
        cumulated().postprocess(good, dest)
    with pytest.raises(ValueError, match="Expected a valid `new_first_variable_name`"):
        cumulated().postprocess(good, dest.drop("first"))


OPEN = [20, 3, 31, 9, 50, 14, 42, 71]
CLOSE = [26, 5, 33, 15, 58, 25, 47, 72]


def ranges(**kwargs):
    return InterRecordRangeDifferenceProcessor(
        "id", "start", "end", "start", "first", "range", "diff", "k", **kwargs
    )


def test_ranges(make):
    df = make("id bigint, start bigint, end bigint", id=OWNERS, start=OPEN, end=CLOSE)
    first, diff = [0] * 8, [0.0] * 8
    for rows in by_owner(OWNERS, sorted(range(8), key=lambda i: OPEN[i])).values():
        for n, i in enumerate(rows):
            first[i] = OPEN[rows[0]]
            diff[i] = float(OPEN[i] - CLOSE[rows[n - 1]]) if n else 0.0
    model = ranges(keep_record_order=True)
    out = model.preprocess(df)
    got = rows_of(out)
    assert got["range"] == [e - s for s, e in zip(OPEN, CLOSE)]
    assert got["first"] == first and got["diff"] == diff
    back = rows_of(model.postprocess(df, out))
    assert back["start"] == OPEN and back["end"] == CLOSE


def test_ranges_more_records(make):
    df = make("id bigint, start bigint, end bigint", id=OWNERS, start=OPEN, end=CLOSE)
    owners, spans, diffs = [5, 8, 5, 8, 5], [2, 6, 1, 3, 9], [0, 0, 4, 7, 1]
    first = [50 if o == 5 else 3 for o in owners]
    dest = make("id bigint, range bigint, first bigint, diff bigint", id=owners, range=spans, first=first, diff=diffs)
    start, end, last = [], [], {}
    for owner, span, begin, diff in zip(owners, spans, first, diffs):
        start.append(last.get(owner, begin) + diff)
        end.append(start[-1] + span)
        last[owner] = end[-1]
    back = rows_of(ranges().postprocess(df, dest))
    assert back["start"] == start and back["end"] == end


def test_ranges_errors(make):
    df = make("id bigint, start bigint, end bigint", id=[6], start=[None], end=[9])
    with pytest.raises(ValueError, match="Expected no missing values for"):
        ranges().preprocess(df)
    with pytest.raises(ValueError, match="Expected valid variable names for"):
        ranges().preprocess(df.drop("end"))
    with pytest.raises(ValueError, match="Expected valid variable names for"):
        ranges().postprocess(df, df)


def relative(before, after, low, high):
    """The step as a share of the room up to ``high`` or down to ``low``."""
    if after == before:
        return 0.0
    return (after - before) / (high - before) if after > before else (after - before) / (before - low)


def bounded(**kwargs):
    return InterRecordBoundedCumulatedDifferenceProcessor("id", "value", "first", "diff", "k", **kwargs)


def test_bounded(make):
    df = make("id bigint, value bigint", id=OWNERS, value=READINGS)
    low, high, first, diff = min(READINGS), max(READINGS), [0] * 8, [0.0] * 8
    for rows in by_owner(OWNERS, range(8)).values():
        for before, i in zip([rows[0], *rows], rows):
            first[i], diff[i] = READINGS[rows[0]], relative(READINGS[before], READINGS[i], low, high)
    model = bounded(should_round_output=True).fit(df)
    out = model.preprocess(df)
    got = rows_of(out)
    assert got["first"] == first and got["diff"] == near(diff, abs=1e-9)
    assert rows_of(model.postprocess(df, out))["value"] == READINGS
    other = out.withColumn("diff", F.sin(F.col("k") * 2.5))
    values = rows_of(model.postprocess(df, other))["value"]
    assert min(values) >= low and max(values) <= high


def test_bounded_errors(make):
    df = make("id bigint, value bigint", id=[4, None], value=[6, 9])
    with pytest.raises(ValueError, match="Expected no missing values for id variable"):
        bounded().fit(df).preprocess(df)
    good = make("id bigint, value bigint", id=[4], value=[6])
    dest = make("id bigint, first bigint, diff double", id=[4], first=[None], diff=[0.3])
    with pytest.raises(ValueError, match="`new_first_variable_name`"):
        bounded().fit(good).postprocess(good, dest)
    with pytest.raises(ValueError, match="id variable in source"):
        bounded().fit(df).postprocess(df, dest)


FROM, TO, RANK = [12, 40, 33, 25, 90, 18, 64, 52], [30, 35, 60, 20, 75, 2, 64, 80], [5, 2, 9, 1, 4, 3, 8, 7]


def bounded_range(**kwargs):
    return InterRecordBoundedRangeDifferenceProcessor(
        "id", "s", "e", "first", "range", "diff", "k", **kwargs
    )


@pytest.fixture
def moves(make):
    return make("s bigint, e bigint, b bigint, id bigint", s=FROM, e=TO, b=RANK, id=OWNERS)


def expected_moves(order):
    low, high = min(FROM + TO), max(FROM + TO)
    first, diff = [0] * 8, [0.0] * 8
    for rows in by_owner(OWNERS, order).values():
        for n, i in enumerate(rows):
            first[i] = FROM[rows[0]]
            diff[i] = relative(TO[rows[n - 1]], FROM[i], low, high) if n else 0.0
    return [relative(s, e, low, high) for s, e in zip(FROM, TO)], first, diff


@pytest.mark.parametrize("integers", [True, False])
def test_bounded_range(moves, integers):
    model = bounded_range(should_round_output=integers).fit(moves)
    out = model.preprocess(moves)
    got, (span, first, diff) = rows_of(out), expected_moves(range(8))
    assert got["range"] == near(span, abs=1e-9) and got["first"] == first
    assert got["diff"] == near(diff, abs=1e-9)
    back = model.postprocess(moves, out)
    assert back.columns == ["s", "e", "b", "id", "k"]
    assert rows_of(back)["s"] == near(FROM) and rows_of(back)["e"] == near(TO)
    if integers:
        assert dict(back.dtypes)["s"] == "bigint"


def test_bounded_range_sorted(moves):
    got = rows_of(bounded_range(sort_by_variable="b").fit(moves).preprocess(moves))
    span, first, diff = expected_moves(sorted(range(8), key=lambda i: RANK[i]))
    assert got["range"] == near(span, abs=1e-9) and got["first"] == first
    assert got["diff"] == near(diff, abs=1e-9)


def test_bounded_range_truncates_on_request(moves, make):
    # from 50 a quarter of the room up to 90 is 60; from 50 a seventh is 55.71
    dest = make("b bigint, id bigint, range double, first bigint, diff double",
                b=[1], id=[3], range=[1 / 7], first=[50], diff=[0.0])
    cut = bounded_range(integer_mode="truncate").fit(moves)
    assert rows_of(cut.postprocess(moves, dest))["e"] == [55]
    kept = bounded_range().fit(moves)
    assert rows_of(kept.postprocess(moves, dest))["e"] == [56]


def test_bounded_range_errors(moves):
    with pytest.raises(ValueError, match="Expected valid variable names for"):
        bounded_range(sort_by_variable="zz").fit(moves).preprocess(moves)
    broken = moves.withColumn("s", F.when(F.col("k") > 0, F.col("s")))
    with pytest.raises(ValueError, match="Expected no missing values for"):
        bounded_range().fit(broken).preprocess(broken)


# -- geolocation -------------------------------------------------------------------------------

def geo(refs, bins):
    return GeolocationNormalizationProcessor("y", "x", refs, bins)


def test_geolocation(make):
    lon = [3.21, 3.19, 3.11, 3.18]
    df = make("y double, x double", y=[49.1, 49.2, 49.3, 49.3], x=lon)
    model = geo(3, 5).fit(df)
    out = model.preprocess(df)
    assert rows_of(out)["x"] == near([0.5, 0.5, 0.0, 1.0])
    assert rows_of(model.postprocess(df, out))["x"] == near(lon)


def test_geolocation_single_longitude_even_bins(make):
    df = make("y double, x double", y=[0.0, 1.0, 1.0], x=[5.0, 2.0, 4.0])
    assert rows_of(geo(2, 4).fit(df).preprocess(df))["x"][0] == near(0.0)


def test_geolocation_inverse_stays_inside(make):
    lat = [i * 0.37 % 5 for i in range(200)]
    lon = [(i * 1.7) % 11 + (20 if i % 3 else 0) for i in range(200)]
    df = make("y double, x double", y=lat, x=lon)
    model = geo(10, 5).fit(df)
    forward = rows_of(model.preprocess(df))["x"]
    assert min(forward) >= 0 and max(forward) <= 1
    dest = df.withColumn("x", F.col("k") / 199.0)
    back = rows_of(model.postprocess(df, dest))["x"]
    assert min(back) >= min(lon) and max(back) <= max(lon) + 1e-9
    assert rows_of(model.postprocess(df, model.preprocess(df)))["x"] == near(lon)


def test_geolocation_with_empty_latitudes(make):
    df = make("y double, x double", y=[0.0, 0.1, 10.0, 9.9, 4.4], x=[1.0, 2.0, 3.0, 4.0, 1.5])
    model = geo(6, 3).fit(df)
    assert model.present == (0, 2, 5)
    assert rows_of(model.postprocess(df, model.preprocess(df)))["x"] == near(rows_of(df)["x"])


def test_geolocation_needs_two_references():
    with pytest.raises(ValueError, match="at least 2"):
        geo(1, 5)
