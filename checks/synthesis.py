"""Synthesis of one table on customers with hash-injected gaps."""

from __future__ import annotations

from math import floor, log2

from pyspark.sql import functions as F

from checks.common import Suite, r, sfine, sr, su, table
from maskloom.functions.uniform import uniform
from maskloom.operators.neighbors import nearest
from maskloom.operators.synthesis.advise import advise
from maskloom.operators.synthesis.encode import fit_encoder
from maskloom.operators.synthesis.generate import (
    attach_excluded,
    neighbor_weights,
    shuffle_rows,
    synthesize,
    weighted_rows,
)
from maskloom.operators.synthesis.impute import add_missing_flags, impute
from maskloom.operators.synthesis.noise import private_rows
from maskloom.operators.synthesis.project import fit_space
from maskloom.operators.synthesis.sparse import fit_sparse_space
from maskloom.session import materialize

suite = Suite()

GAP_SQL = f"""
select c_custkey as id, case when {su(1, 'gap', 'c_custkey')} >= 0.1 then c_acctbal end as balance,
       c_nationkey as nation,
       case when {su(2, 'gap', 'c_custkey')} >= 0.05 then c_mktsegment end as segment from customer"""


def gaps(spark, sf):
    balance = F.when(uniform(1, "gap", "c_custkey") >= 0.1, F.col("c_acctbal"))
    segment = F.when(uniform(2, "gap", "c_custkey") >= 0.05, F.col("c_mktsegment"))
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), balance.alias("balance"),
        F.col("c_nationkey").alias("nation"), segment.alias("segment"))


def full(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"),
        F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))


FULL_SQL = "select c_custkey as id, c_acctbal as balance, c_nationkey as nation, c_mktsegment as segment from customer"


@suite.add("a01_missing_flags", f"""
select id, cast(balance is null as int) as balance__isna, cast(segment is null as int) as segment__isna from ({GAP_SQL})""")
def a01(spark, sf):
    out = add_missing_flags(gaps(spark, sf), ["balance", "segment"])
    return out.select("id", "balance__isna", "segment__isna")


MODE_SQL = "(select segment from g where segment is not null group by 1 order by count(*) desc, segment limit 1)"


def _impute_sql(value: str) -> str:
    return f"""with g as ({GAP_SQL})
select id, {sr(f"coalesce(balance, (select {value} from g limit 1))")} as balance, nation,
       coalesce(segment, {MODE_SQL}) as segment from g"""


for _method, _value in (("mean", "avg(balance)"), ("median", "quantile_cont(balance, 0.5)"),
                        ("mode", "(select balance from g where balance is not null group by 1 order by count(*) desc, balance limit 1)")):
    def _query(spark, sf, method=_method):
        out = impute(gaps(spark, sf), ["balance", "segment"], method=method, row_key="id")
        return out.withColumn("balance", r("balance"))

    suite.add(f"a02_impute_{_method}", _impute_sql(_value))(_query)


def _knn_sql(fraction: str) -> str:
    return f"""
with g as ({GAP_SQL}),
     z as (select *, (balance - (select avg(balance) from g)) / (select stddev_pop(balance) from g) as zb,
                  (nation - (select avg(nation) from g)) / (select stddev_pop(nation) from g) as zn from g),
     d as (select * from z where balance is not null and segment is not null {fraction}),
     n as (select q.id, q.balance as qb, q.segment as qs, d.balance as db, d.segment as ds,
                  row_number() over (partition by q.id order by
                    (case when q.zb is null then 0 else (q.zb - d.zb) * (q.zb - d.zb) end) + (q.zn - d.zn) * (q.zn - d.zn), d.id) as rk
           from z q, d where q.balance is null or q.segment is null),
     v as (select id, ds, count(*) as c from n where rk <= 5 group by 1, 2),
     m as (select id, ds from (select *, row_number() over (partition by id order by c desc, ds) as p from v) where p = 1),
     a as (select id, avg(db) as b from n where rk <= 5 group by 1)
select g.id as id, {sr("coalesce(g.balance, a.b)")} as balance, nation, coalesce(g.segment, m.ds) as segment
from g left join a on a.id = g.id left join m on m.id = g.id"""


@suite.add("a03_impute_knn", _knn_sql(""))
def a03(spark, sf):
    out = impute(gaps(spark, sf), ["balance", "segment"], method="knn", row_key="id", k=5)
    return out.withColumn("balance", r("balance"))


# every fifth or so of 20 figures per part has gaps: 2^20 possible patterns of what a row lacks
FIGURES = [(f"{how}_{name}", how, f"l_{name}") for name in ("quantity", "extendedprice", "discount", "tax", "linenumber")
           for how in ("min", "max", "sum", "span")]
HOW = {"min": "min({0})", "max": "max({0})", "span": "max({0}) - min({0})", "sum": "sum(cast(round({0} * 100) as bigint))"}


def _many_gaps_sql() -> str:
    names = [n for n, _, _ in FIGURES]
    made = ", ".join(f"cast({HOW[how].format(c)} as double) as {n}" for n, how, c in FIGURES)
    holes = ", ".join(f"case when {su(i, 'gap', 'id')} >= 0.05 then {n} end as {n}" for i, n in enumerate(names))
    z = ", ".join(f"({n} - avg({n}) over ()) / stddev_pop({n}) over () as z_{n}" for n in names)
    whole = " and ".join(f"{n} is not null" for n in names)
    asked = " and ".join(f"q.{n} is not null" for n in names)
    far = " + ".join(f"(case when q.z_{n} is null then 0 else (q.z_{n} - d.z_{n}) * (q.z_{n} - d.z_{n}) end)" for n in names)
    means = ", ".join(f"avg(d_{n}) as m_{n}" for n in names)
    given = ", ".join(f"d.{n} as d_{n}" for n in names)
    out = ", ".join(f"{sr(f'coalesce(g.{n}, a.m_{n})')} as {n}" for n in names)
    return f"""
with p as (select l_partkey as id, {made} from lineitem group by 1), g as (select id, {holes} from p),
     z as (select *, {z} from g), d as (select * from z where {whole}),
     n as (select q.id, {given}, row_number() over (partition by q.id order by {far}, d.id) as rk
           from z q, d where not ({asked})),
     a as (select id, {means} from n where rk <= 5 group by 1)
select g.id, {out} from g left join a on a.id = g.id"""


@suite.add("a03_impute_many_gaps", _many_gaps_sql())
def a03b(spark, sf):
    names = [n for n, _, _ in FIGURES]
    parts = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("id")).agg(
        *[F.expr(HOW[how].format(c)).cast("double").alias(n) for n, how, c in FIGURES])
    holes = parts.select("id", *[F.when(uniform(i, "gap", "id") >= 0.05, F.col(n)).alias(n) for i, n in enumerate(names)])
    out = impute(holes, names, method="knn", row_key="id", k=5)
    return out.select("id", *[r(n).alias(n) for n in names])


@suite.add("a04_impute_fast_knn", _knn_sql(f"and {su(8, 'impute', 'id')} < 0.4"))
def a04(spark, sf):
    out = impute(gaps(spark, sf), ["balance", "segment"], method="fast_knn", row_key="id", k=5,
                 training_fraction=0.4, seed=8)
    return out.withColumn("balance", r("balance"))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _encode_sql(weight: str, factor: str = "1.0") -> str:
    ones = ", ".join(
        f"coalesce({sr(f'(cast(segment = {chr(39)}{s}{chr(39)} as int) - (select avg(cast(segment = {chr(39)}{s}{chr(39)} as int)) from f)) / sqrt((select avg(cast(segment = {chr(39)}{s}{chr(39)} as int)) from f)) * {factor}')}, 0) as s_{s.lower()}"
        for s in SEGMENTS)
    return f"""with f as ({FULL_SQL})
select id, {sr(f"(balance - (select avg(balance) from f)) / (select stddev_pop(balance) from f) * {weight}")} as z_balance,
       {sr("(nation - (select avg(nation) from f)) / (select stddev_pop(nation) from f)")} as z_nation, {ones} from f"""


def _encoded(spark, sf, weights):
    df = full(spark, sf)
    encoder = fit_encoder(df, ["balance", "nation", "segment"], weights)
    out = encoder.encode(df, "id")
    levels = [f.level for f in encoder.features if f.level]
    cols = [r(F.col("features")[0]).alias("z_balance"), r(F.col("features")[1]).alias("z_nation")]
    for s in SEGMENTS:
        value = r(F.col("features")[2 + levels.index(s)]) if s in levels else F.lit(0.0)
        cols.append(value.alias(f"s_{s.lower()}"))
    return out.select("id", *cols)


@suite.add("a05_encode", _encode_sql("1.0"))
def a05(spark, sf):
    return _encoded(spark, sf, None)


@suite.add("a06_column_weights", _encode_sql("sqrt(4.0)", "sqrt(0.25)"))
def a06(spark, sf):
    return _encoded(spark, sf, {"balance": 4.0, "segment": 0.25})


@suite.add("a07_categorical_reduction")
def a07(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    space = fit_space(df, df.columns[1:], row_key="p_partkey", ncp=5, use_categorical_reduction=True)
    out = space.place(df, "p_partkey")
    return out.select("p_partkey", *[r(F.col("features")[i]).alias(f"x{i}") for i in range(5)])


@suite.add("a08_sparse_names", """
select count(*) as n, true as centred, true as uncorrelated, true as falling, true as explained from orders""")
def a08s(spark, sf):
    """A column of names (the customer of each order) next to numbers and small categories, projected."""
    df = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("customer "), F.col("o_custkey")).alias("name"),
        F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"))
    space = fit_sparse_space(df, ["name", "priority", "status", "price"], row_key="id", ncp=3, passes=3)
    placed = materialize(space.place(df, "id").select("id", *[F.col("features")[j].alias(f"f{j}") for j in range(3)]))
    small = lambda c: F.abs(c) < 1e-6
    row = placed.agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(f"f{j}").alias(f"m{j}") for j in range(3)],
        *[F.var_pop(f"f{j}").alias(f"v{j}") for j in range(3)],
        *[F.covar_pop(f"f{i}", f"f{j}").alias(f"c{i}{j}") for i in range(3) for j in range(i)])
    own = F.lit(True)
    for j in range(3):
        own = own & small(F.col(f"v{j}") - F.lit(float(space.explained[j])))
    return row.select(
        "n", (small(F.col("m0")) & small(F.col("m1")) & small(F.col("m2"))).alias("centred"),
        (small(F.col("c10")) & small(F.col("c20")) & small(F.col("c21"))).alias("uncorrelated"),
        ((F.col("v0") >= F.col("v1")) & (F.col("v1") >= F.col("v2")) & (F.col("v2") > 0)).alias("falling"),
        own.alias("explained"))


@suite.add("a08_projection")
def a08(spark, sf):
    df = full(spark, sf)
    out = fit_space(df, ["balance", "nation", "segment"], row_key="id", ncp=5).place(df, "id")
    return out.select("id", *[r(F.col("features")[i]).alias(f"x{i}") for i in range(5)])


def pca_two_sql(source: str, key: str, x: str, y: str) -> str:
    """Components of two centred columns in closed form, as CTEs ``c`` (loadings) and ``proj``."""
    return f"""
m as (select var_samp({x}) as a, covar_samp({x}, {y}) as b, var_samp({y}) as d from {source}),
l as (select *, (a + d + sqrt((a - d) * (a - d) + 4 * b * b)) / 2 as l1,
             (a + d - sqrt((a - d) * (a - d) + 4 * b * b)) / 2 as l2 from m),
u as (select *, b / sqrt(b * b + (l1 - a) * (l1 - a)) as p1, (l1 - a) / sqrt(b * b + (l1 - a) * (l1 - a)) as q1,
             b / sqrt(b * b + (l2 - a) * (l2 - a)) as p2, (l2 - a) / sqrt(b * b + (l2 - a) * (l2 - a)) as q2 from l),
c as (select l1, l2, p1 * s1 as p1, q1 * s1 as q1, p2 * s2 as p2, q2 * s2 as q2 from (
        select *, case when abs(p1) >= abs(q1) then sign(p1) else sign(q1) end as s1,
               case when abs(p2) >= abs(q2) then sign(p2) else sign(q2) end as s2 from u)),
proj as (select {key} as id, {x} * p1 + {y} * q1 as x1, {x} * p2 + {y} * q2 as x2 from {source}, c)"""


TWO_SQL = f"""
f as ({FULL_SQL}),
z as (select id, (balance - (select avg(balance) from f)) / (select stddev_pop(balance) from f) * sqrt(4.0) as zx,
             (nation - (select avg(nation) from f)) / (select stddev_pop(nation) from f) as zy from f),
{pca_two_sql('z', 'id', 'zx', 'zy')}"""


def two_space(spark, sf):
    df = full(spark, sf)
    return df, fit_space(df, ["balance", "nation"], row_key="id", ncp=2, weights={"balance": 4.0})


@suite.add("a08_projection_two", f"""
with {TWO_SQL} select id, {sr('x1')} as x1, {sr('x2')} as x2 from proj""")
def a08c(spark, sf):
    df, space = two_space(spark, sf)
    at = F.col("features")
    return space.place(df, "id").select("id", r(at[0]).alias("x1"), r(at[1]).alias("x2"))


@suite.add("a08_projection_embeddings")
def a08b(spark, sf):
    df = table(spark, sf, "embeddings")
    wide = df.select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)])
    out = fit_space(wide, wide.columns[1:], row_key="vec_id", ncp=5).place(wide, "vec_id")
    return out.select("vec_id", *[r(F.col("features")[i]).alias(f"x{i}") for i in range(5)])


A9_SQL = """
n as (select q.id as query_id, d.id as neighbor_id,
             sqrt((q.x - d.x) * (q.x - d.x) + (q.y - d.y) * (q.y - d.y)) as distance,
             row_number() over (partition by q.id order by (q.x - d.x) * (q.x - d.x) + (q.y - d.y) * (q.y - d.y), d.id) as rk
      from v q, v d where q.id <> d.id)"""


@suite.add("a09_nearest_neighbors", f"""
with v as (select c_custkey as id, c_acctbal / 1000.0 as x, c_nationkey * 1.0 as y from customer), {A9_SQL}
select query_id, neighbor_id, {sr('distance')} as distance, cast(rk as int) as rank from n where rk <= 10""")
def a09(spark, sf):
    point = F.array(F.col("c_acctbal") / 1000.0, F.col("c_nationkey") * F.lit(1.0))
    df = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), point.alias("features"))
    out = nearest(df, df, 10, query_key="id", candidate_key="id", exclude_self=True)
    return out.withColumn("distance", r("distance"))


@suite.add("a09_nearest_by_partition", f"""
with q as (select c_custkey as id, c_acctbal / 40.0 as x, c_nationkey * 10.0 as y from customer),
     d as (select o_orderkey as id, o_totalprice / 1000.0 as x, day(o_orderdate) * 8.0 as y from orders),
     p as (select q.id as query_id, d.id as neighbor_id, (q.x - d.x) * (q.x - d.x) + (q.y - d.y) * (q.y - d.y) as d2
           from q, d),
     n as (select *, row_number() over (partition by query_id order by d2, neighbor_id) as rk from p)
select query_id, neighbor_id, {sr('sqrt(d2)')} as distance, cast(rk as int) as rank from n where rk <= 5""")
def a09c(spark, sf):
    q = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.array(
        F.col("c_acctbal") / 40.0, F.col("c_nationkey") * F.lit(10.0)).alias("features"))
    d = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.array(
        F.col("o_totalprice") / 1000.0, F.day("o_orderdate") * F.lit(8.0)).alias("features"))
    out = nearest(q, d, 5, query_key="id", candidate_key="id", part_rows=1_000)
    return out.withColumn("distance", r("distance"))


@suite.add("a09_nearest_embeddings", """
with e as (select vec_id as id, embedding::double[] as x from embeddings),
     n as (select q.id as query_id, d.id as neighbor_id,
             list_sum(list_transform(list_zip(q.x, d.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as d2
           from e q, e d where q.id <> d.id)
select query_id, neighbor_id, cast(rk as int) as rank from (
  select *, row_number() over (partition by query_id order by round(d2, 12), neighbor_id) as rk from n) where rk <= 5""")
def a09b(spark, sf):
    df = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("features"))
    out = nearest(df, df, 5, query_key="id", candidate_key="id", exclude_self=True)
    return out.select("query_id", "neighbor_id", "rank")


GEN_SQL = f"""
f as ({FULL_SQL}),
v as (select id, (balance - (select avg(balance) from f)) / (select stddev_pop(balance) from f) as x,
             (nation - (select avg(nation) from f)) / (select stddev_pop(nation) from f) as y from f), {A9_SQL},
w as (select query_id, neighbor_id, 1.0 / greatest(distance, 1e-9) * -ln(1.0 - {su(21, 'generate:weight', 'query_id', 'neighbor_id')})
             * pow(2.0, -row_number() over (partition by query_id order by {su(21, 'generate:rank', 'query_id', 'neighbor_id')}, neighbor_id)) as weight
      from n where rk <= 8)"""


def _weights(spark, sf):
    df = full(spark, sf)
    points = fit_space(df, ["balance", "nation"], row_key="id", ncp=None).place(df, "id")
    near = nearest(points, points, 8, query_key="id", candidate_key="id", exclude_self=True)
    return df, neighbor_weights(near, 21)


@suite.add("a10_neighbor_weights", f"""
with {GEN_SQL}
select query_id, neighbor_id, {sr("weight / sum(weight) over (partition by query_id)")} as share from w""")
def a10(spark, sf):
    _, weights = _weights(spark, sf)
    totals = weights.groupBy("query_id").agg(F.sum("weight").alias("t"))
    share = F.col("weight") / F.col("t")
    return weights.join(totals, "query_id").select("query_id", "neighbor_id", r(share).alias("share"))


@suite.add("a11_weighted_rows", f"""
with {GEN_SQL},
     s as (select query_id, segment, sum(weight) as t from w join f on f.id = neighbor_id group by 1, 2),
     m as (select query_id, segment from (select *, row_number() over (partition by query_id order by t desc, segment) as p from s) where p = 1)
select query_id as id, {sr("sum(weight * balance) / sum(weight)", 4)} as balance,
       cast(round(sum(weight * nation) / sum(weight)) as int) as nation, any_value(m.segment) as segment
from w join f on f.id = neighbor_id join m using (query_id) group by 1""")
def a11(spark, sf):
    df, weights = _weights(spark, sf)
    out = weighted_rows(weights, df, "id", ["balance", "nation", "segment"])
    return out.withColumn("balance", r("balance", 4))


@suite.add("a12_unshuffled", f"""
with {GEN_SQL}
select query_id as id, {sr("sum(weight * balance) / sum(weight)", 4)} as balance,
       cast(round(sum(weight * nation) / sum(weight)) as int) as nation
from w join f on f.id = neighbor_id group by 1""")
def a12(spark, sf):
    out = synthesize(full(spark, sf), "id", k=8, ncp=None, columns=["balance", "nation"], seed=21)
    return out.unshuffled.withColumn("balance", r("balance", 4))


@suite.add("a13_shuffled", f"""
with {GEN_SQL},
     u as (select query_id as id, {sr("sum(weight * balance) / sum(weight)", 4)} as balance,
                  cast(round(sum(weight * nation) / sum(weight)) as int) as nation
           from w join f on f.id = neighbor_id group by 1)
select row_number() over (order by {su(33, 'publish', 'id')}, id) - 1 as id, balance, nation from u""")
def a13(spark, sf):
    out = synthesize(full(spark, sf), "id", k=8, ncp=None, columns=["balance", "nation"], seed=21)
    return shuffle_rows(out.unshuffled, "id", seed=33).withColumn("balance", r("balance", 4))


@suite.add("a13_synthesis_mixed")
def a13b(spark, sf):
    out = synthesize(gaps(spark, sf), "id", k=10, ncp=5, seed=5)
    return shuffle_rows(out.unshuffled, "id", seed=6).withColumn("balance", r("balance"))


@suite.add("a14_excluded_row_order", "select c_custkey as id, c_mktsegment as segment from customer")
def a14(spark, sf):
    df = full(spark, sf)
    out = synthesize(df, "id", k=8, ncp=None, columns=["balance", "nation"], seed=21)
    return attach_excluded(out, df, ["segment"]).select("id", "segment")


@suite.add("a15_excluded_similarity", f"""
with {GEN_SQL},
     u as (select query_id as id, sum(weight * balance) / sum(weight) as balance,
                  cast(round(sum(weight * nation) / sum(weight)) as int) as nation from w join f on f.id = neighbor_id group by 1),
     p as (select id, (balance - (select avg(balance) from f)) / (select stddev_pop(balance) from f) as x,
             (nation - (select avg(nation) from f)) / (select stddev_pop(nation) from f) as y from u),
     c as (select p.id as id, v.id as donor, row_number() over (partition by p.id order by
             round((p.x - v.x) * (p.x - v.x) + (p.y - v.y) * (p.y - v.y), 13), v.id) as rk from p, v)
select c.id as id, f.segment as segment from c join f on f.id = c.donor where rk = 1""")
def a15(spark, sf):
    df = full(spark, sf)
    out = synthesize(df, "id", k=8, ncp=None, columns=["balance", "nation"], seed=21)
    return attach_excluded(out, df, ["segment"], strategy="coordinate_similarity").select("id", "segment")


def _noise_sql(width: float, share: float, stream: str, key: str) -> tuple[str, str]:
    """Two-sided geometric noise, and the step of its grid, for values that one row changes by ``width``."""
    grid = 2.0 ** (floor(log2(width / share)) - 20)
    scale = (width + (grid if width != 1 else 0)) / share
    if width == 1:
        grid = 1.0
    step = lambda sign: f"floor(-ln(1.0 - {sfine(13, stream + sign, key)}) * {scale / grid!r})"
    return f"(({step('+')} - {step('-')}) * {grid!r})", repr(grid)


def _private_sql(gaps: bool) -> str:
    own = 0.25 if gaps else 0.5
    total, grid = _noise_sql(11000.0, 0.5, "sum:balance", "'balance'")
    count, _ = _noise_sql(1, 0.5, "count:balance", "'balance'")
    cell, step = _noise_sql(11000.0, own, "cell:balance", "id")
    value = f"greatest(least(coalesce(round((c - mu) / {step}) * {step}, 0.0) + {cell} + mu, 10000.0), -1000.0)"
    moved = f"""case when {su(13, 'keep:segment', 'id')} < exp({own}) / (exp({own}) + 4) and pos is not null then segment
            when pos is not null then list_extract({SEGMENTS}, (pos - 1 + cast(floor({su(13, 'jump:segment', 'id')} * 4) as int) + 1) % 5 + 1)
            else list_extract({SEGMENTS}, cast(floor({su(13, 'jump:segment', 'id')} * 5) as int) + 1) end"""
    if gaps:
        hide = "case when ({0} is null) = ({1} < exp(0.25) / (exp(0.25) + 1)) then null else {2} end"
        value = hide.format("balance", su(13, "gap:balance", "id"), value)
        moved = hide.format("segment", su(13, "gap:segment", "id"), moved)
    return f"""
with f as ({GAP_SQL if gaps else FULL_SQL}),
     b as (select case when balance is not null then greatest(least(balance, 10000.0), -1000.0) end as c, * from f),
     m as (select greatest(least(4500.0 + (coalesce(sum(cast(round((c - 4500.0) / {grid}) as hugeint)), 0)::double * {grid} + {total})
                  / greatest(count(c) + {count}, 1.0), 10000.0), -1000.0) as mu from b),
     k as (select *, list_position({SEGMENTS}, segment) as pos from b)
select id, {'case when v is not null then ' if gaps else ''}{sr('v')}{' end' if gaps else ''} as balance, segment from (
  select id, {value} as v, {moved} as segment from k, m)"""


PRIVATE = {"epsilon": 2.0, "bounds": {"balance": (-1000.0, 10000.0)}, "modalities": {"segment": SEGMENTS}}


@suite.add("a16_private_rows", _private_sql(False))
def a16(spark, sf):
    out = private_rows(full(spark, sf), "id", **PRIVATE, seed=13)
    return out.withColumn("balance", r("balance"))


@suite.add("a16_private_with_gaps", _private_sql(True))
def a16b(spark, sf):
    out = private_rows(gaps(spark, sf), "id", **PRIVATE, missing=["balance", "segment"], seed=13)
    return out.withColumn("balance", F.when(F.col("balance").isNotNull(), r("balance")))


@suite.add("a17_advice", """
with l as (select count(distinct p_name) + count(distinct p_brand) + count(distinct p_type) as levels, count(*) as n from part)
select 'part' as table_name, cast(greatest(5, least(50, floor(sqrt(n) / 2 + 0.5))) as int) as k,
       cast(least(5, 2 + levels) as int) as ncp, levels > 20 as use_categorical_reduction from l""")
def a17(spark, sf):
    return advise(table(spark, sf, "part"), "p_partkey", "part")
