"""Privacy and utility metrics on a hash-perturbed twin of the customers."""

from __future__ import annotations

from math import ceil

from pyspark.sql import functions as F

from checks.common import Suite, r, sr, su, table
from checks.synthesis import TWO_SQL, two_space
from maskloom.functions.uniform import uniform
from maskloom.operators.metrics import privacy, signal
from maskloom.operators.neighbors import task_count
from maskloom.operators.synthesis.project import fit_space

suite = Suite()

#: Customers whose attributes a task draws at least.
DRAWN_ROWS = 5_000

SOURCE_SQL = """
select c_custkey as id, c_acctbal as balance, c_nationkey as nation, c_mktsegment as segment from customer"""
TWIN_SQL = f"""
select c_custkey as id, case when {su(1, 'twin', 'c_custkey')} < 0.2 then c_acctbal
            else c_acctbal + ({su(2, 'twin', 'c_custkey')} - 0.5) * 1500.0 end as balance,
       cast((c_nationkey + cast(floor({su(3, 'twin', 'c_custkey')} * 3) as int)) % 25 as int) as nation,
       case when {su(4, 'twin', 'c_custkey')} < 0.7 then c_mktsegment else 'MACHINERY' end as segment
from customer"""


def source(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"),
        F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))


def twin(spark, sf):
    def u(n):
        return uniform(n, "twin", "c_custkey")

    balance = F.when(u(1) < 0.2, F.col("c_acctbal")).otherwise(
        F.col("c_acctbal") + (u(2) - 0.5) * 1500.0)
    nation = ((F.col("c_nationkey") + F.floor(u(3) * 3).cast("int")) % 25).cast("int")
    segment = F.when(u(4) < 0.7, F.col("c_mktsegment")).otherwise("MACHINERY")
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), balance.alias("balance"), nation.alias("nation"),
        segment.alias("segment"))


def points(spark, sf):
    """Coordinates by fixed scales, so that SQL sees the same digits."""
    def place(df):
        at = F.array(F.col("balance") / 1000.0, F.col("nation") * F.lit(1.0))
        return df.select("id", at.alias("features"))

    return place(source(spark, sf)), place(twin(spark, sf))


def one(spark, **values):
    names = list(values)
    row = tuple(None if values[n] is None else float(values[n]) for n in names)
    df = spark.createDataFrame([row], ", ".join(f"{n} double" for n in names))
    return df.select(*[r(n).alias(n) for n in names])


D2 = "(a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)"
POINTS_SQL = f"""
o as (select id, balance / 1000.0 as x, nation * 1.0 as y from ({SOURCE_SQL})),
s as (select id, balance / 1000.0 as x, nation * 1.0 as y from ({TWIN_SQL}))"""
OS_SQL = f"""{POINTS_SQL},
os as (select a.id as id, b.id as other, {D2} as d2,
              row_number() over (partition by a.id order by {D2}, b.id) as rk from o a, s b)"""
SO_SQL = f"""{POINTS_SQL},
so as (select a.id as id, b.id as other, {D2} as d2,
              row_number() over (partition by a.id order by {D2}, b.id) as rk from s a, o b),
c as (select id, max(case when rk = 1 then sqrt(d2) end) as d1, max(case when rk = 2 then sqrt(d2) end) as d2
      from so group by 1),
q as (select id, d1, case when d2 = 0 then 1.0 else d1 / d2 end as ratio from c)"""


@suite.add("pm01_hidden_rate", f"""
with {OS_SQL} select {sr("100.0 * avg(cast(id <> other as int))")} as hidden_rate from os where rk = 1""")
def pm01(spark, sf):
    a, b = points(spark, sf)
    return one(spark, hidden_rate=privacy.hidden_rate(a, b, "id"))


CLOAK_SQL = f"""{POINTS_SQL},
own as (select a.id as id, a.x as x, a.y as y, {D2} as r2 from o a join s b on a.id = b.id),
n as (select a.id as id, count(case when {D2} < a.r2 then 1 end) as n from own a, s b group by 1)"""


@suite.add("pm02_cloaking_counts", f"with {CLOAK_SQL} select id as query_id, n from n")
def pm02(spark, sf):
    a, b = points(spark, sf)
    return privacy.cloaking_counts(a, b, "id")


@suite.add("pm02_local_cloaking", f"with {CLOAK_SQL} select {sr('quantile_cont(n, 0.5)')} as local_cloaking from n")
def pm02b(spark, sf):
    a, b = points(spark, sf)
    return one(spark, local_cloaking=privacy.local_cloaking(a, b, "id"))


@suite.add("pm03_distance_to_closest", f"""
with {SO_SQL} select {sr('quantile_cont(d1, 0.5)')} as dcr_median, {sr('quantile_cont(d1, 0.05)')} as dcr_p5 from q""")
def pm03(spark, sf):
    a, b = points(spark, sf)
    return one(spark, **privacy.distance_to_closest(privacy.closest_distances(a, b, "id")))


@suite.add("pm04_nearest_ratio", f"with {SO_SQL} select {sr('quantile_cont(ratio, 0.5)')} as nndr from q")
def pm04(spark, sf):
    a, b = points(spark, sf)
    return one(spark, nndr=privacy.nearest_neighbor_ratio(privacy.closest_distances(a, b, "id")))


@suite.add("pm05_closest_rate", f"""
with {SO_SQL},
oo as (select a.id, min(sqrt({D2})) as d from o a, o b where a.id <> b.id group by 1),
t as (select quantile_cont(d, 0.5) as t from oo)
select {sr("100.0 * avg(cast(d1 < t and ratio < 0.7 as int))")} as closest_rate from q, t""")
def pm05(spark, sf):
    a, b = points(spark, sf)
    closest = privacy.closest_distances(a, b, "id")
    return one(spark, closest_rate=privacy.closest_rate(
        a, closest, "id", percentage_threshold=0.5, ratio_threshold=0.7))


COLUMNS = ["balance", "nation", "segment"]


@suite.add("pm06_column_direct_match", f"with o as ({SOURCE_SQL}), s as ({TWIN_SQL})" + " union all ".join(
    f"""
select '{c}' as "column", {sr(f"100.0 - 100.0 * avg(cast(o.{c} is not distinct from s.{c} as int))")} as protection
from o join s on o.id = s.id""" for c in COLUMNS))
def pm06(spark, sf):
    out = privacy.column_direct_match(source(spark, sf), twin(spark, sf), "id", COLUMNS)
    return out.withColumn("protection", r("protection"))


@suite.add("pm07_row_direct_match", f"""
with o as ({SOURCE_SQL}), s as ({TWIN_SQL})
select {sr("100.0 - 100.0 * avg(cast(exists(select 1 from o where o.balance = s.balance and o.nation = s.nation and o.segment = s.segment) as int))")} as protection from s""")
def pm07(spark, sf):
    v = privacy.row_direct_match_protection(source(spark, sf), twin(spark, sf), COLUMNS)
    return one(spark, protection=v)


@suite.add("pm08_categorical_hidden_rate", f"""
with o as ({SOURCE_SQL}), s as ({TWIN_SQL}),
h as (select a.id as id, b.id as other, cast(a.nation <> b.nation as int) + cast(a.segment <> b.segment as int) as d from o a, s b),
m as (select id, min(d) as m from h group by 1),
t as (select h.id as id, count(*) as ties, max(cast(h.id = other as int)) as own from h join m on h.id = m.id and d = m group by 1)
select {sr("100.0 * avg(1.0 - own / ties::double)")} as hidden_rate from t""")
def pm08(spark, sf):
    v = privacy.categorical_hidden_rate(source(spark, sf), twin(spark, sf), "id", ["nation", "segment"])
    return one(spark, hidden_rate=v)


def _attributes(m: int):
    """``m`` columns of 2 to 6 values per customer, and a twin in which a quarter of the values moved on."""
    of = [(i, 2 + i % 5) for i in range(m)]
    draw = lambda s, i: su(s, f"attribute{i}", "c_custkey")
    own = {i: f"cast(floor({draw(5, i)} * {k}) as int)" for i, k in of}
    made = {i: f"(case when {draw(6, i)} < 0.25 then ({own[i]} + 1) % {k} else {own[i]} end)" for i, k in of}
    select = lambda which: "select c_custkey as id, " + ", ".join(
        f"{v} as a{i}" for i, v in which.items()) + " from customer"
    apart = " + ".join(f"cast(a.a{i} <> b.a{i} as int)" for i, _ in of)
    sql = f"""
with o as materialized ({select(own)}), s as materialized ({select(made)}),
h as (select a.id as id, b.id as other, {apart} as d from o a, s b),
m as (select id, min(d) as m from h group by 1),
t as (select h.id as id, count(*) as ties, max(cast(h.id = other as int)) as own from h join m on h.id = m.id and d = m group by 1)
select {sr("100.0 * avg(1.0 - own / ties::double)")} as hidden_rate from t"""

    def tables(spark, sf):
        df = table(spark, sf, "customer").select("c_custkey")
        # the draws are dear, and a file is read by few tasks
        df = df.repartition(task_count(df, ceil(df.count() / DRAWN_ROWS)))
        plain = {i: F.floor(uniform(5, f"attribute{i}", "c_custkey") * k).cast("int") for i, k in of}
        moved = {i: F.when(uniform(6, f"attribute{i}", "c_custkey") < 0.25, (plain[i] + 1) % k).otherwise(plain[i])
                 for i, k in of}
        return [df.select(F.col("c_custkey").alias("id"), *[v.alias(f"a{i}") for i, v in which.items()])
                for which in (plain, moved)]

    return sql, tables


for _m in (12, 30):
    _sql, _tables = _attributes(_m)

    def _many(spark, sf, m=_m, tables=_tables):
        a, b = tables(spark, sf)
        return one(spark, hidden_rate=privacy.categorical_hidden_rate(a, b, "id", [f"a{i}" for i in range(m)]))

    suite.add(f"pm08_categorical_hidden_rate_{_m}", _sql)(_many)


@suite.add("v1_correlations_wide", f"""
with e as (select vec_id, unnest(range(192)) as j, embedding from embeddings),
v as (select vec_id, j::int as j, case when (vec_id * 7 + j * 13) % 11 <> 0 then
        case j // 64 when 0 then x when 1 then x * x else x * y end end as v
      from (select vec_id, j, embedding[j % 64 + 1]::double as x, embedding[(j + 1) % 64 + 1]::double as y from e))
select 'c' || p.j as a, 'c' || q.j as b, {sr('corr(p.v, q.v)')} as rho
from v p join v q using (vec_id) group by p.j, q.j""")
def v1w(spark, sf):
    """192 columns with gaps: entries of embeddings, their squares and products."""
    df = table(spark, sf, "embeddings").withColumn("e", F.col("embedding").cast("array<double>"))
    kinds = [lambda x, y: x, lambda x, y: x * x, lambda x, y: x * y]
    value = [kinds[j // 64](F.col("e")[j % 64], F.col("e")[(j + 1) % 64]) for j in range(192)]
    wide = df.select(*[F.when((F.col("vec_id") * 7 + j * 13) % 11 != 0, value[j]).alias(f"c{j}") for j in range(192)])
    return signal.correlations(wide, wide.columns).withColumn("rho", r("rho"))


def _near_sql(name: str, column: str) -> str:
    z = f"({{}}.{column} - m.{name}m) / m.{name}s"
    d = f"(({z.format('a')}) - ({z.format('b')})) * (({z.format('a')}) - ({z.format('b')}))"
    return f"""
{name} as (select id, other from (select a.id as id, b.id as other,
   row_number() over (partition by a.id order by {d}, b.id) as rk
   from src a, twn b, (select avg({column}) as {name}m, stddev_pop({column}) as {name}s from src) m) where rk = 1)"""


SN_SQL = f"src as ({SOURCE_SQL}), twn as ({TWIN_SQL})"


@suite.add("pm09_correlation_protection", f"""
with {SN_SQL}, {_near_sql('k', 'balance')}, {_near_sql('u', 'nation')}
select {sr("100.0 * avg(cast(k.other <> u.other as int))")} as protection from k join u on k.id = u.id""")
def pm09(spark, sf):
    v = privacy.correlation_protection_rate(
        source(spark, sf), twin(spark, sf), "id", ["balance"], ["nation"])
    return one(spark, protection=v)


@suite.add("pm10_inference_continuous", f"""
with {SN_SQL}, {_near_sql('k', 'balance')}
select {sr("100.0 * avg(cast(abs(twn.nation - src.nation) > abs(src.nation) * 0.1 as int))")} as protection
from k join twn on twn.id = k.other join src on src.id = k.id""")
def pm10(spark, sf):
    v = privacy.inference(source(spark, sf), twin(spark, sf), "id", ["balance"], "nation", continuous=True)
    return one(spark, protection=v)


@suite.add("pm11_inference_categorical", f"""
with {SN_SQL}, {_near_sql('k', 'balance')}
select {sr("100.0 * avg(cast(twn.segment <> src.segment as int))")} as protection
from k join twn on twn.id = k.other join src on src.id = k.id""")
def pm11(spark, sf):
    v = privacy.inference(source(spark, sf), twin(spark, sf), "id", ["balance"], "segment", continuous=False)
    return one(spark, protection=v)


def _places(df):
    lat = F.col("nation") * 2.0 + F.col("balance") / 9000.0
    return df.select("id", lat.alias("lat"), (F.col("balance") / 500.0).alias("lon"))


def _sphere_sql(base: str) -> str:
    lat, lon = "radians(nation * 2.0 + balance / 9000.0)", "radians(balance / 500.0)"
    return f"select id, cos({lat}) * cos({lon}) as x, cos({lat}) * sin({lon}) as y, sin({lat}) as z from ({base})"


D3 = "(a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)"


@suite.add("pm12_geolocation_privacy", f"""
with o as ({_sphere_sql(SOURCE_SQL)}), s as ({_sphere_sql(TWIN_SQL)}),
os as (select a.id as id, b.id as other, {D3} as d2, row_number() over (partition by a.id order by round({D3}, 15), b.id) as rk from o a, s b),
so as (select b.id as id, min({D3}) as d2 from o a, s b group by 1),
own as (select id, d2 as r2 from os where id = other),
n as (select os.id, count(case when d2 < r2 and os.id <> other then 1 end) as n from os join own on os.id = own.id group by 1)
select {sr("(select 100.0 * avg(cast(id <> other as int)) from os where rk = 1)")} as hidden_rate,
       {sr("(select quantile_cont(n, 0.5) from n)")} as local_cloaking,
       {sr("(select quantile_cont(2 * 6371.0088 * asin(least(sqrt(d2) / 2, 1.0)), 0.5) from so)", 4)} as dcr_median""")
def pm12(spark, sf):
    v = privacy.geolocation_privacy(
        _places(source(spark, sf)), _places(twin(spark, sf)), "id", "lat", "lon")
    out = one(spark, **v)
    return out.withColumn("dcr_median", r("dcr_median", 4))


# -- utility -----------------------------------------------------------------------------------

def _bin20(x: str) -> str:
    raw = f"greatest(least(cast(floor(({x} - lo) / (hi - lo) * 20.0) as int), 19), 0)"
    edge = lambda i: f"(case when {i} >= 20 then hi else {i} * ((hi - lo) / 20.0) + lo end)"
    return (f"cast({raw} + case when {x} < {edge(raw)} and {raw} > 0 then -1 "
            f"when {x} >= {edge(f'({raw} + 1)')} and {raw} < 19 then 1 else 0 end as varchar)")


def _shares_sql() -> str:
    parts = []
    for c in ("balance", "nation"):
        limits = f"(select least(min(o.{c}), min(s.{c}))::double as lo, greatest(max(o.{c}), max(s.{c}))::double as hi from o join s on o.id = s.id)"
        for side in ("o", "s"):
            parts.append(f"select '{c}' as col, {_bin20(c + '::double')} as bin, '{side}' as side from {side}, {limits}")
    for side in ("o", "s"):
        parts.append(f"select 'segment' as col, segment as bin, '{side}' as side from {side}")
    return f"""
o as ({SOURCE_SQL}), s as ({TWIN_SQL}), cells as ({' union all '.join(parts)}),
shares as (select col, bin, count(*) filter (side = 'o') / (select count(*) from o)::double as p,
                  count(*) filter (side = 's') / (select count(*) from s)::double as q from cells group by 1, 2)"""


@suite.add("v5_distributions", f"""
with {_shares_sql()} select col as "column", bin, {sr('p')} as original, {sr('q')} as synthetic from shares""")
def v5(spark, sf):
    out = signal.distributions(source(spark, sf), twin(spark, sf), COLUMNS)
    return out.withColumns({c: r(c) for c in ("original", "synthetic")})


@suite.add("sm1_hellinger", f"""
with {_shares_sql()}, h as (select col, sqrt(greatest(1 - sum(sqrt(p * q)), 0)) as h from shares group by 1)
select {sr('avg(h)')} as hellinger_mean, {sr('stddev_samp(h)')} as hellinger_std from h""")
def sm1(spark, sf):
    return one(spark, **signal.hellinger(source(spark, sf), twin(spark, sf), COLUMNS))


LINES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _lines(spark, sf):
    df = table(spark, sf, "lineitem").select(*LINES)
    moved = df.withColumn("l_extendedprice", F.when(F.col("l_discount") < 0.05, 50000.0).otherwise(F.col("l_extendedprice")))
    return df, moved


MOVED = "(select l_quantity, case when l_discount < 0.05 then 50000.0 else l_extendedprice end as l_extendedprice, l_discount, l_tax from lineitem)"


def _corr_sql(base: str) -> str:
    return " union all ".join(
        f"select '{a}' as a, '{b}' as b, corr({a}, {b}) as rho from {base}" for a in LINES for b in LINES)


@suite.add("v1_correlations", f"select a, b, {sr('rho')} as rho from ({_corr_sql('lineitem')})")
def v1(spark, sf):
    out = signal.correlations(_lines(spark, sf)[0], LINES)
    return out.withColumn("rho", r("rho"))


@suite.add("v2_correlation_difference", f"""
with p as ({_corr_sql('lineitem')}), q as ({_corr_sql(MOVED)})
select p.a as a, p.b as b, {sr('p.rho - q.rho')} as difference from p join q on p.a = q.a and p.b = q.b""")
def v2(spark, sf):
    out = signal.correlation_difference(*_lines(spark, sf), LINES)
    return out.withColumn("difference", r("difference"))


@suite.add("sm2_correlation_difference_ratio", f"""
with p as ({_corr_sql('lineitem')}), q as ({_corr_sql(MOVED)})
select {sr('100.0 * avg(cast(abs(p.rho - q.rho) > 0.1 as int))')} as ratio
from p join q on p.a = q.a and p.b = q.b where p.a < p.b""")
def sm2(spark, sf):
    return one(spark, ratio=signal.correlation_difference_ratio(*_lines(spark, sf), LINES))


@suite.add("v3_contributions")
def v3(spark, sf):
    df = source(spark, sf)
    space = fit_space(df, COLUMNS, row_key="id", ncp=3)
    return signal.contributions(df, space).withColumn("contribution", r("contribution"))


@suite.add("v3_contributions_two", f"""
with {TWO_SQL}
select 'balance' as "column", 1 as component, {sr('p1 * p1 * l1 / (l1 + l2)')} as contribution from c
union all select 'nation', 1, {sr('q1 * q1 * l1 / (l1 + l2)')} from c
union all select 'balance', 2, {sr('p2 * p2 * l2 / (l1 + l2)')} from c
union all select 'nation', 2, {sr('q2 * q2 * l2 / (l1 + l2)')} from c""")
def v3b(spark, sf):
    df, space = two_space(spark, sf)
    return signal.contributions(df, space).withColumn("contribution", r("contribution"))


@suite.add("v4_projection_points_two", f"""
with {TWO_SQL}, t as ({TWIN_SQL}),
tz as (select id, (balance - (select avg(balance) from f)) / (select stddev_pop(balance) from f) * sqrt(4.0) as zx,
              (nation - (select avg(nation) from f)) / (select stddev_pop(nation) from f) as zy from t)
select id, 'original' as side, {sr('x1')} as x1, {sr('x2')} as x2 from proj
union all select id, 'synthetic', {sr('zx * p1 + zy * q1')}, {sr('zx * p2 + zy * q2')} from tz, c""")
def v4b(spark, sf):
    df, space = two_space(spark, sf)
    out = signal.projection_points(
        space.place(df, "id"), space.place(twin(spark, sf), "id"), "id", 2)
    return out.withColumns({c: r(c) for c in ("x1", "x2")})


@suite.add("v4_projection_points")
def v4(spark, sf):
    df, other = source(spark, sf), twin(spark, sf)
    space = fit_space(df, COLUMNS, row_key="id", ncp=3)
    out = signal.projection_points(space.place(df, "id"), space.place(other, "id"), "id", 3)
    return out.withColumns({c: r(c) for c in ("x1", "x2", "x3")})


@suite.add("v6_aggregate_stats", f"with o as ({SOURCE_SQL}), s as ({TWIN_SQL})" + " union all ".join(
    f"""
select '{c}' as "column", '{side}' as side, {sr(f'avg({c})')} as mean, {sr(f'stddev_samp({c})')} as std from {t}"""
    for c in ("balance", "nation") for side, t in (("original", "o"), ("synthetic", "s"))))
def v6(spark, sf):
    out = signal.aggregate_stats(source(spark, sf), twin(spark, sf), COLUMNS)
    return out.withColumns({c: r(c) for c in ("mean", "std")})
