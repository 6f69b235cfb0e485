"""Processors: forward and backward on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.common import Suite, micros, r, sr, su, table
from maskloom.functions.rounding import saferound_columns, saferound_groups
from maskloom.functions.uniform import uniform
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
    ProportionProcessor,
    RelativeDifferenceProcessor,
    ToCategoricalProcessor,
)

suite = Suite()


# -- dates -------------------------------------------------------------------------------------

@suite.add("p01_datetime_pre", f"""
select event_id, {sr("epoch_us(ts) / 1e6")} as ts from events""")
def p01(spark, sf):
    df = table(spark, sf, "events").select("event_id", "ts")
    return DatetimeProcessor().fit(df).preprocess(df).select("event_id", r("ts").alias("ts"))


@suite.add("p02_datetime_post", """
select o_orderkey, cast(epoch_us(o_orderdate) + 43200000000 as bigint) as micros from orders""")
def p02(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    model = DatetimeProcessor().fit(df)
    later = model.preprocess(df).withColumn("o_orderdate", F.col("o_orderdate") + 43200.0)
    out = model.postprocess(df, later)
    return out.select("o_orderkey", micros("o_orderdate").alias("micros"))


# -- categories --------------------------------------------------------------------------------

LINE_NUMBERS = ["l_linenumber", "l_tax", "l_discount", "l_quantity"]


@suite.add("p03_to_categorical_pre", """
select cast(l_linenumber as varchar) as l_linenumber, cast(l_tax as varchar) as l_tax,
       cast(l_discount as varchar) as l_discount, l_quantity,
       l_linenumber as l_linenumber__cont, l_tax as l_tax__cont, l_discount as l_discount__cont
from lineitem""")
def p03(spark, sf):
    df = table(spark, sf, "lineitem").select(*LINE_NUMBERS)
    model = ToCategoricalProcessor(11, keep_continuous=True).fit(df)
    return model.preprocess(df)


@suite.add("p04_to_categorical_post", f"""
select o_orderkey,
       cast(case when n <= 3 then n + 100 else n end as bigint) as n
from (select l_orderkey as o_orderkey, count(*) as n from lineitem group by 1)""")
def p04(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    df = lines.agg(F.count(F.lit(1)).alias("n"))
    model = ToCategoricalProcessor(50, keep_continuous=True).fit(df.select("n"))
    encoded = model.preprocess(df)
    grouped = encoded.withColumns({
        "n": F.when(F.col("n__cont") <= 3, F.lit("other")).otherwise(F.col("n")),
        "n__cont": F.col("n__cont") + 100,
    })
    return model.postprocess(df, grouped)


@suite.add("p05_group_modalities_columns", """
with b as (select p_brand as v, count(*) as n from part group by 1),
     n as (select p_name as v, count(*) as n from part group by 1)
select p_partkey, case when b.n <= 80 then 'other' else p_brand end as p_brand,
       case when n.n <= 30 then 'other' else p_name end as p_name
from part join b on p_brand = b.v join n on p_name = n.v""")
def p05(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_brand", "p_name")
    model = GroupModalitiesProcessor(variable_thresholds={"p_brand": 80, "p_name": 30}).fit(df)
    return model.preprocess(df)


@suite.add("p06_group_modalities_generic", """
with b as (select p_brand as v, count(*) as n from part group by 1),
     n as (select p_name as v, count(*) as n from part group by 1)
select p_partkey, p_type, case when b.n <= 70 then 'rest' else p_brand end as p_brand,
       case when n.n <= 70 then 'rest' else p_name end as p_name
from part join b on p_brand = b.v join n on p_name = n.v""")
def p06(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_brand", "p_name", "p_type")
    model = GroupModalitiesProcessor(
        min_unique=10, global_threshold=70, new_category="rest"
    ).fit(df)
    return model.postprocess(df, model.preprocess(df))


# -- perturbation ------------------------------------------------------------------------------

def _customer_twin(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    source = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    u = uniform(3, "twin", "c_custkey")
    dest = source.withColumns({
        "c_acctbal": F.col("c_acctbal") + (u - 0.5) * 1000.0,
        "c_mktsegment": F.concat(F.col("c_mktsegment"), F.lit("*")),
    })
    return source, dest


@suite.add("p07_perturbation_numeric", f"""
select c_custkey, {sr("c_acctbal + ((c_acctbal + (" + su(3, "twin", "c_custkey") +
                      " - 0.5) * 1000.0) - c_acctbal) * 0.3")} as c_acctbal,
       concat(c_mktsegment, '*') as c_mktsegment
from customer""")
def p07(spark, sf):
    source, dest = _customer_twin(spark, sf)
    model = PerturbationProcessor("c_custkey", {"c_acctbal": 0.3, "c_mktsegment": 1.0}).fit(source)
    return model.postprocess(source, dest).withColumn("c_acctbal", r("c_acctbal"))


@suite.add("p08_perturbation_categorical", f"""
select c_custkey, case when {su(11, "perturb:c_mktsegment", "c_custkey")} < 0.25
       then concat(c_mktsegment, '*') else c_mktsegment end as c_mktsegment
from customer""")
def p08(spark, sf):
    source, dest = _customer_twin(spark, sf)
    model = PerturbationProcessor("c_custkey", {"c_mktsegment": 0.25}, seed=11).fit(source)
    return model.postprocess(source, dest).select("c_custkey", "c_mktsegment")


# -- proportions and rounding ------------------------------------------------------------------

PIVOT_SQL = """
select l_orderkey as k, sum(l_quantity) as total,
       sum(case when l_returnflag = 'A' then l_quantity end) as a,
       sum(case when l_returnflag = 'N' then l_quantity end) as n,
       sum(case when l_returnflag = 'R' then l_quantity end) as r
from lineitem group by 1"""


def _pivot(spark: SparkSession, sf: str) -> DataFrame:
    def part(flag: str):
        return F.sum(F.when(F.col("l_returnflag") == flag, F.col("l_quantity"))).alias(flag.lower())

    return table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(
        F.sum("l_quantity").alias("total"), part("A"), part("N"), part("R")
    )


def _parts_sum(p: str) -> str:
    return f"(coalesce({p}a, 0) + coalesce({p}n, 0) + coalesce({p}r, 0))"


@suite.add("p09_proportion_pre", f"""
with p as ({PIVOT_SQL})
select k, total, {sr(f"a / nullif({_parts_sum('')}, 0)")} as a,
       {sr(f"n / nullif({_parts_sum('')}, 0)")} as n, {sr(f"r / nullif({_parts_sum('')}, 0)")} as r
from p""")
def p09(spark, sf):
    df = _pivot(spark, sf)
    out = ProportionProcessor(["a", "n", "r"], "total").fit(df).preprocess(df)
    return out.select("k", "total", *[r(c).alias(c) for c in "anr"])


@suite.add("p09_proportion_pre_reference", f"""
with p as ({PIVOT_SQL})
select k, total, {sr("a / nullif(total, 0)")} as a, {sr("n / nullif(total, 0)")} as n,
       {sr("r / nullif(total, 0)")} as r from p""")
def p09b(spark, sf):
    df = _pivot(spark, sf)
    model = ProportionProcessor(["a", "n", "r"], "total", sum_to_one=False).fit(df)
    return model.preprocess(df).select("k", "total", *[r(c).alias(c) for c in "anr"])


def _saferound_sql(source: str, columns: list[str], places: int, strategy: str, topline: str | None):
    """Closed form over a few columns of ``source``; columns hold doubles without nulls."""
    inc = f"{10.0 ** -places!r}" if places < 0 else None
    total = " + ".join(["0.0"] + columns)
    goal = f"round({topline or total}, {places})"
    rs = [f"__r{i}" for i in range(len(columns))]
    rounded = ", ".join(f"round({c}, {places}) as {x}" for c, x in zip(columns, rs))
    m = len(columns)
    order = {
        "difference": lambda i: f"(({rs[i]} - {columns[i]}) * sign(__n))",
        "largest": lambda i: f"(-{rs[i]})",
        "smallest": lambda i: f"({rs[i]})",
    }[strategy]
    outs = []
    for i, c in enumerate(columns):
        ahead = " + ".join(
            f"(case when {order(j)} < {order(i)}"
            + (f" or {order(j)} = {order(i)}" if j < i else "") + " then 1 else 0 end)"
            for j in range(m) if j != i
        )
        units = f"(((abs(__n) // {m}) + case when ({ahead}) < abs(__n) % {m} then 1 else 0 end) * sign(__n))"
        step = f"{units} * {inc}" if inc else f"{units} / {10.0 ** places!r}"
        outs.append(f"{sr(f'round({rs[i]} + {step}, {places})')} as {c}")
    scale = f"/ {inc}" if inc else f"* {10.0 ** places!r}"
    return f"""
with s1 as ({source}), s2 as (select *, {goal} as __goal, {rounded} from s1),
     s3 as (select *, cast(round((__goal - ({' + '.join(['0.0'] + rs)})) {scale}) as bigint) as __n from s2)
select k, {', '.join(outs)} from s3"""


P10_SOURCE = f"""
select k, coalesce(a, 0) * price / nullif({_parts_sum('')}, 0) as a,
       coalesce(n, 0) * price / nullif({_parts_sum('')}, 0) as n,
       coalesce(r, 0) * price / nullif({_parts_sum('')}, 0) as r
from ({PIVOT_SQL}) join (select o_orderkey as k2, o_totalprice * 1.00037 as price from orders) on k = k2"""


@suite.add("p10_proportion_post", _saferound_sql(P10_SOURCE, ["a", "n", "r"], 1, "difference", None))
def p10(spark, sf):
    # a reference without exact halves: engines round those differently
    price = (F.col("o_totalprice") * 1.00037).alias("o_totalprice")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), price)
    dest = _pivot(spark, sf).na.fill(0.0, ["a", "n", "r"]).join(orders, "k")
    model = ProportionProcessor(["a", "n", "r"], "o_totalprice").fit(dest)
    out = model.postprocess(dest, dest)
    return out.select("k", *[r(c).alias(c) for c in "anr"])


@suite.add("p10_proportion_post_reference", f"""
with p as ({PIVOT_SQL})
select k, total, {sr("a * total")} as a, {sr("n * total")} as n, {sr("r * total")} as r from p""")
def p10b(spark, sf):
    df = _pivot(spark, sf)
    model = ProportionProcessor(["a", "n", "r"], "total", sum_to_one=False).fit(df)
    return model.postprocess(df, df).select("k", "total", *[r(c).alias(c) for c in "anr"])


SPLIT_SQL = """
select o_orderkey as k, o_totalprice * 0.1234 as a, o_totalprice * 0.3333 as n,
       o_totalprice * 0.5433 as r, o_totalprice * 1.0001 as top from orders"""


def _split(spark, sf):
    price = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"), (price * 0.1234).alias("a"), (price * 0.3333).alias("n"),
        (price * 0.5433).alias("r"), (price * 1.0001).alias("top"),
    )


def _rounding_query(places: int, strategy: str, topline: str | None):
    def query(spark, sf):
        out = saferound_columns(
            _split(spark, sf), ["a", "n", "r"], places, strategy=strategy, topline=topline
        )
        return out.select("k", *[r(c).alias(c) for c in "anr"])

    return query


for _places, _strategy, _top in [
    (2, "difference", None), (0, "largest", "top"), (0, "smallest", "top"), (-3, "difference", None),
]:
    _name = f"l1_saferound_{_strategy}_{'minus' if _places < 0 else ''}{abs(_places)}"
    suite.add(_name, _saferound_sql(SPLIT_SQL, ["a", "n", "r"], _places, _strategy, _top))(
        _rounding_query(_places, _strategy, _top)
    )


@suite.add("l2_saferound_groups", f"""
with s as (select o_orderkey, o_orderpriority, o_totalprice / 7.0 as v, round(o_totalprice / 7.0, 0) as rv
           from orders),
     g as (select o_orderpriority as gp, count(*) as m,
                  cast(round(round(sum(v), 0) - sum(rv)) as bigint) as n from s group by 1),
     t as (select *, row_number() over (partition by o_orderpriority
             order by round((rv - v) * sign(n), 12), o_orderkey) as place
           from s join g on gp = o_orderpriority)
select o_orderkey, o_orderpriority,
       {sr("rv + ((abs(n) // m) + case when place <= abs(n) % m then 1 else 0 end) * sign(n)")} as rounded
from t""")
def l2(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", (F.col("o_totalprice") / 7.0).alias("v")
    )
    out = saferound_groups(df, ["o_orderpriority"], "v", "o_orderkey", 0)
    return out.select("o_orderkey", "o_orderpriority", r("rounded").alias("rounded"))


# -- relative difference -----------------------------------------------------------------------

@suite.add("p11_relative_difference_pre", f"""
select p_partkey, p_size, p_retailprice,
       {sr("(p_retailprice - (0.0 + p_size + p_partkey)) / 10.0")} as gap from part""")
def p11(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    model = RelativeDifferenceProcessor("p_retailprice", ["p_size", "p_partkey"], 10, "gap").fit(df)
    return model.preprocess(df).withColumn("gap", r("gap"))


@suite.add("p12_relative_difference_post", f"""
select p_partkey, p_size, {sr("(p_retailprice - p_size) / 10.0 + 1.5")} as gap,
       {sr("((p_retailprice - p_size) / 10.0 + 1.5) * 10.0 + p_size")} as p_retailprice from part""")
def p12(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    model = RelativeDifferenceProcessor(
        "p_retailprice", ["p_size"], 10, "gap", drop_original_target=True
    ).fit(df)
    dest = model.preprocess(df).withColumn("gap", F.col("gap") + 1.5)
    out = model.postprocess(df, dest)
    return out.withColumns({"gap": r("gap"), "p_retailprice": r("p_retailprice")})


# -- expected mean -----------------------------------------------------------------------------

def _segments(spark, sf):
    segment = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    return table(spark, sf, "customer").select(
        "c_custkey", segment.alias("segment"), F.col("c_acctbal").alias("v")
    )


SEGMENT_SQL = "select c_custkey, nullif(c_mktsegment, 'BUILDING') as segment, c_acctbal as v from customer"


@suite.add("p13_expected_mean_fit", f"""
select segment, {sr("avg(v)", 4)} as vmean, {sr("stddev_samp(v)", 4)} as vstd from ({SEGMENT_SQL}) group by 1""")
def p13(spark, sf):
    model = ExpectedMeanProcessor(["v"], groupby_variables=["segment"]).fit(_segments(spark, sf))
    return model.statistics.select("segment", r("vmean", 4).alias("vmean"), r("vstd", 4).alias("vstd"))


def _p14_sql(std: bool) -> str:
    factor = "* (w.s / c.s)" if std else ""
    return f"""
with src as ({SEGMENT_SQL}),
     dst as (select c_custkey, segment, v * 1.5 + c_custkey % 11 as v from src),
     c as (select segment, avg(v) as m, stddev_samp(v) as s from dst group by 1),
     w as (select segment, avg(v) as m, stddev_samp(v) as s from src where segment is null or segment <> 'MACHINERY' group by 1)
select c_custkey, dst.segment as segment, {sr(f"w.m + (dst.v - c.m) {factor}", 4)} as v
from dst join c on dst.segment is not distinct from c.segment
         join w on dst.segment is not distinct from w.segment"""


def _p14(std: bool):
    def query(spark, sf):
        source = _segments(spark, sf)
        dest = source.withColumn("v", F.col("v") * 1.5 + F.col("c_custkey") % 11)
        reference = source.where("segment is null or segment <> 'MACHINERY'")
        model = ExpectedMeanProcessor(["v"], groupby_variables=["segment"], same_std=std).fit(reference)
        return model.postprocess(source, dest).withColumn("v", r("v", 4))

    return query


suite.add("p14_expected_mean_post", _p14_sql(False))(_p14(False))
suite.add("p14_expected_mean_post_std", _p14_sql(True))(_p14(True))


# -- records of one individual -----------------------------------------------------------------

CUMULATED = InterRecordCumulatedDifferenceProcessor(
    "user_id", "value", "first_value", "step", "event_id", keep_record_order=True
)
P15_SQL = """
select event_id, user_id,
       first_value(value) over w as first_value,
       coalesce(value - lag(value) over w, 0) as step
from events window w as (partition by user_id order by value, event_id)"""


def _events(spark, sf):
    return table(spark, sf, "events").select("event_id", "user_id", "value")


@suite.add("p15_cumulated_difference_pre", f"""
select event_id, user_id, first_value, {sr("step")} as step from ({P15_SQL})""")
def p15(spark, sf):
    df = _events(spark, sf)
    return CUMULATED.fit(df).preprocess(df).withColumn("step", r("step"))


@suite.add("p16_cumulated_difference_post", f"select event_id, user_id, {sr('value')} as value from events")
def p16(spark, sf):
    df = _events(spark, sf)
    out = CUMULATED.postprocess(df, CUMULATED.preprocess(df))
    return out.withColumn("value", r("value"))


@suite.add("p16_cumulated_difference_post_dest_order", f"""
with p as ({P15_SQL})
select event_id, user_id, {sr("first_value + sum(step) over (partition by user_id order by event_id)")} as value
from p""")
def p16b(spark, sf):
    df = _events(spark, sf)
    model = InterRecordCumulatedDifferenceProcessor(
        "user_id", "value", "first_value", "step", "event_id"
    )
    return model.postprocess(df, model.preprocess(df)).withColumn("value", r("value"))


BOUNDED = InterRecordBoundedCumulatedDifferenceProcessor(
    "user_id", "value", "first_value", "step", "event_id", order_by=("ts",)
)
B_SQL = """
select event_id, user_id, ts, value, lo, hi,
       first_value(value) over w as first_value,
       coalesce(lag(value) over w, value) as prev, row_number() over w as i
from events, (select min(value) as lo, max(value) as hi from events)
window w as (partition by user_id order by ts, event_id)"""


def _relative(value: str, prev: str) -> str:
    return (
        f"coalesce(case when {value} >= {prev} then abs({value} - {prev}) / nullif(abs({prev} - hi), 0) "
        f"else -abs({value} - {prev}) / nullif(abs({prev} - lo), 0) end, 0)"
    )


def _moved(step: str, prev: str) -> str:
    return f"({prev} + {step} * case when {step} >= 0 then abs({prev} - hi) else abs({prev} - lo) end)"


def _timed(spark, sf):
    return table(spark, sf, "events").select("event_id", "user_id", "ts", "value")


@suite.add("p17_bounded_cumulated_pre", f"""
select event_id, user_id, epoch_us(ts) as ts, first_value, {sr(_relative('value', 'prev'))} as step
from ({B_SQL})""")
def p17(spark, sf):
    df = _timed(spark, sf)
    out = BOUNDED.fit(df).preprocess(df)
    return out.withColumns({"step": r("step"), "ts": micros("ts")})


@suite.add("p18_bounded_cumulated_post", f"""
with recursive b as ({B_SQL}),
     d as (select event_id, user_id, i, lo, hi, first_value, {_relative('value', 'prev')} * 0.75 as step from b),
     f as (select event_id, user_id, i, lo, hi, {_moved('step', 'first_value')} as v from d where i = 1
           union all
           select d.event_id, d.user_id, d.i, d.lo, d.hi, {_moved('d.step', 'f.v').replace(' hi)', ' d.hi)').replace(' lo)', ' d.lo)')}
           from f join d on d.user_id = f.user_id and d.i = f.i + 1)
select event_id, user_id, {sr('v')} as value from f""")
def p18(spark, sf):
    df = _timed(spark, sf)
    model = BOUNDED.fit(df)
    dest = model.preprocess(df).withColumn("step", F.col("step") * 0.75)
    out = model.postprocess(df, dest)
    return out.select("event_id", "user_id", r("value").alias("value"))


RANGES = InterRecordRangeDifferenceProcessor(
    "user_id", "s", "e", "s", "first_s", "length", "gap", "event_id", keep_record_order=True
)
RANGE_SQL = """
select event_id, user_id, (epoch_us(ts) - epoch_us(timestamp '2024-01-01')) / 1e6 as s,
       (epoch_us(ts) - epoch_us(timestamp '2024-01-01')) / 1e6 + value as e from events"""


def _ranges(spark, sf):
    start = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2024-01-01', ts) / 1e6D"
    return table(spark, sf, "events").selectExpr(
        "event_id", "user_id", f"{start} as s", f"{start} + value as e"
    )


@suite.add("p19_range_difference_pre", f"""
select event_id, user_id, {sr("e - s")} as length, {sr("first_value(s) over w")} as first_s,
       {sr("coalesce(s - lag(e) over w, 0)")} as gap
from ({RANGE_SQL}) window w as (partition by user_id order by s, event_id)""")
def p19(spark, sf):
    df = _ranges(spark, sf)
    out = RANGES.fit(df).preprocess(df)
    return out.withColumns({c: r(c) for c in ("length", "first_s", "gap")})


@suite.add("p20_range_difference_post", f"select event_id, user_id, {sr('s')} as s, {sr('e')} as e from ({RANGE_SQL})")
def p20(spark, sf):
    df = _ranges(spark, sf)
    out = RANGES.postprocess(df, RANGES.preprocess(df))
    return out.withColumns({"s": r("s"), "e": r("e")})


BOUNDED_RANGE = InterRecordBoundedRangeDifferenceProcessor(
    "user_id", "s", "e", "first_s", "length", "gap", "event_id", sort_by_variable="t",
    should_round_output=False,
)
BR_BASE = """
select event_id, user_id, epoch_us(ts) as t, value as s, 500.0 - value as e from events"""
BR_SQL = f"""
select *, first_value(s) over w as first_s, coalesce(lag(e) over w, s) as prev, row_number() over w as i
from ({BR_BASE}), (select least(min(s), min(e)) as lo, greatest(max(s), max(e)) as hi from ({BR_BASE}))
window w as (partition by user_id order by t, event_id)"""


def _bounded_ranges(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", "user_id", micros("ts").alias("t"), F.col("value").alias("s"),
        (F.lit(500.0) - F.col("value")).alias("e"),
    )


@suite.add("p21_bounded_range_pre", f"""
select event_id, user_id, t, {sr(_relative('e', 's'))} as length, first_s,
       {sr(_relative('s', 'prev'))} as gap from ({BR_SQL})""")
def p21(spark, sf):
    df = _bounded_ranges(spark, sf)
    return BOUNDED_RANGE.fit(df).preprocess(df).withColumns({"length": r("length"), "gap": r("gap")})


def _p22_sql() -> str:
    first_start = _moved("gap", "first_s")
    next_start = _moved("d.gap", "f.e").replace(" hi)", " d.hi)").replace(" lo)", " d.lo)")
    return f"""
with recursive b as ({BR_SQL}),
     d as (select event_id, user_id, t, i, lo, hi, first_s, {_relative('e', 's')} * 0.5 as length,
                  {_relative('s', 'prev')} * 0.9 as gap from b),
     f as (select event_id, user_id, t, i, lo, hi, s, {_moved('length', 's')} as e
           from (select *, {first_start} as s from d where i = 1)
           union all
           select event_id, user_id, t, i, lo, hi, s, {_moved('length', 's')} as e
           from (select d.*, {next_start} as s from f join d on d.user_id = f.user_id and d.i = f.i + 1))
select event_id, user_id, t, {sr('s')} as s, {sr('e')} as e from f"""


@suite.add("p22_bounded_range_post", _p22_sql())
def p22(spark, sf):
    df = _bounded_ranges(spark, sf)
    model = BOUNDED_RANGE.fit(df)
    dest = model.preprocess(df).withColumns({"length": F.col("length") * 0.5, "gap": F.col("gap") * 0.9})
    return model.postprocess(df, dest).withColumns({"s": r("s"), "e": r("e")})


# -- geolocation -------------------------------------------------------------------------------

GEO = GeolocationNormalizationProcessor("lat", "lon", n_reference_lat=9, n_bins=12)
GEO_SQL = """
select c_custkey, c_nationkey + c_acctbal / 9000.0 as lat,
       case when c_custkey % 3 = 0 then c_acctbal / 1000.0 else 40 + c_acctbal / 1500.0 end as lon
from customer"""


def _places(spark, sf):
    balance = F.col("c_acctbal")
    lon = F.when(F.col("c_custkey") % 3 == 0, balance / 1000.0).otherwise(40 + balance / 1500.0)
    return table(spark, sf, "customer").select(
        "c_custkey", (F.col("c_nationkey") + balance / 9000.0).alias("lat"), lon.alias("lon")
    )


GEO_MODEL_SQL = f"""
pts as ({GEO_SQL}),
lim as (select min(lat) as lo, max(lat) as hi from pts),
refs as (select i, case when i = 8 then hi else i * ((hi - lo) / 8.0) + lo end as ref, 0.5 * ((hi - lo) / 8.0) as tol
         from lim, (select unnest(range(9)) as i)),
mem as (select i, lon from pts, refs where lat >= ref - tol and lat <= ref + tol),
span as (select i, min(lon) as a, max(lon) as b from mem group by 1),
bins as (select i, j, a, b, j * ((b - a) / 12.0) + a as e0,
                case when j = 11 then b else (j + 1) * ((b - a) / 12.0) + a end as e1
         from span, (select unnest(range(12)) as j)),
full_bins as (select i, j, e0, e1 from bins b
              where exists (select 1 from mem m where m.i = b.i and m.lon >= b.e0 and (m.lon < b.e1 or (b.j = 11 and m.lon <= b.e1)))),
slices as (select i, e0, e1, row_number() over (partition by i order by j) - 1 as s,
                  count(*) over (partition by i) as n from full_bins),
near as (select c_custkey, lat, lon, i from (
           select c_custkey, lat, lon, r.i, row_number() over (partition by c_custkey order by abs(ref - lat), r.i) as rk
           from pts, refs r where r.i in (select i from span)) where rk = 1)"""


@suite.add("p23_geolocation_pre", f"""
with {GEO_MODEL_SQL}
select c_custkey, {sr('lat')} as lat,
       {sr("s / n::double + (lon - e0) / (e1 - e0) * ((s / n::double + 1.0 / n) - s / n::double)")} as lon
from (select c_custkey, lat, lon, e0, e1, s, n, row_number() over (
        partition by c_custkey order by case when lon >= e0 and lon < e1 then 0 else 1 end, -s) as pick
      from near join slices using (i)) where pick = 1""")
def p23(spark, sf):
    df = _places(spark, sf)
    return GEO.fit(df).preprocess(df).withColumns({"lat": r("lat"), "lon": r("lon")})


@suite.add("p24_geolocation_post", f"""
with {GEO_MODEL_SQL},
dst as (select c_custkey, lat, i, {su(5, 'place', 'c_custkey')} as p from near)
select c_custkey, {sr('lat')} as lat, {sr("e0 + (p - s / n::double) / (1.0 / n) * (e1 - e0)", 5)} as lon
from (select c_custkey, lat, p, e0, e1, s, n, row_number() over (
        partition by c_custkey order by case when p >= s / n::double and p < s / n::double + 1.0 / n then 0 else 1 end, -s) as pick
      from dst join slices using (i)) where pick = 1""")
def p24(spark, sf):
    df = _places(spark, sf)
    dest = df.withColumn("lon", uniform(5, "place", "c_custkey"))
    return GEO.fit(df).postprocess(df, dest).withColumns({"lat": r("lat"), "lon": r("lon", 5)})
