"""Linked tables (customer <- orders <- lineitem) and series (events by user)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import Suite, micros, r, sr, su, table
from checks.metrics import POINTS_SQL, SOURCE_SQL, TWIN_SQL, one, points, source, twin
from checks.synthesis import pca_two_sql
from maskloom.operators import multitable as mt
from maskloom.operators import timeseries as ts
from maskloom.operators.metrics import privacy, signal
from maskloom.operators.assignment import assign_parents, assignment_bound
from maskloom.operators.neighbors import nearest
from maskloom.operators.synthesis.generate import neighbor_weights
from maskloom.session import materialize

suite = Suite()


@suite.add("m01_key_checks", """
select 'primary_key_null' as rule, 'orders' as table_name, 'o_orderkey' as field, count(*) filter (o_orderkey is null) as violations from orders
union all select 'primary_key_repeated', 'orders', 'o_orderkey', count(*) from (select 1 from orders group by o_orderkey having count(*) > 1)
union all select 'primary_key_null', 'lineitem', 'l_orderkey', count(*) filter (l_orderkey is null) from lineitem
union all select 'primary_key_repeated', 'lineitem', 'l_orderkey', count(*) from (select 1 from lineitem group by l_orderkey having count(*) > 1)
union all select 'foreign_key_unresolved', 'orders', 'o_custkey', count(*) from orders where o_custkey not in (select c_custkey from customer where c_custkey % 7 <> 0)""")
def m01(spark, sf):
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    some = table(spark, sf, "customer").where("c_custkey % 7 <> 0")
    return mt.primary_key_violations(orders, "orders", "o_orderkey").unionByName(
        mt.primary_key_violations(lines, "lineitem", "l_orderkey")).unionByName(
        mt.foreign_key_violations(orders, "orders", "o_custkey", some, "c_custkey"))


def _orders(spark, sf):
    original = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return original, original.drop("o_custkey").withColumn("o_totalprice", F.col("o_totalprice") * 1.1)


@suite.add("m02_link_original_order", f"""
select o_orderkey, o_custkey, {sr('o_totalprice * 1.1')} as o_totalprice from orders""")
def m02(spark, sf):
    original, synthetic = _orders(spark, sf)
    out = mt.relink(synthetic, "o_orderkey", original, "o_custkey")
    return out.withColumn("o_totalprice", r("o_totalprice"))


D2 = "(a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)"


@suite.add("m03_link_minimum_distance", f"""
with {POINTS_SQL},
m as (select id, other from (select a.id as id, b.id as other, row_number() over (partition by a.id order by {D2}, b.id) as rk from o a, s b) where rk = 1)
select o_orderkey, m.other as o_custkey from orders join m on m.id = o_custkey""")
def m03(spark, sf):
    original, synthetic = _orders(spark, sf)
    a, b = points(spark, sf)
    mapping = mt.nearest_parents(a, b, "id")
    return mt.relink(synthetic, "o_orderkey", original, "o_custkey", mapping).select("o_orderkey", "o_custkey")


@suite.add("m04_link_linear_sum")
def m04(spark, sf):
    a, b = points(spark, sf)
    return assign_parents(a, b, "id").withColumn("distance", r("distance"))


@suite.add("m04_link_linear_sum_line", f"""
with o as (select balance, row_number() over (order by balance, id) as pos from ({SOURCE_SQL})),
     s as (select balance, row_number() over (order by balance, id) as pos from ({TWIN_SQL}))
select count(*) as pairs, count(*) as parents, count(*) as targets, {sr('sum(abs(o.balance - s.balance))', 3)} as total
from o join s using (pos)""")
def m04b(spark, sf):
    """On a line the sorted matching is the least assignment, and blocks do not break it."""
    a, b = (df.select("id", F.array("balance").alias("features")) for df in (source(spark, sf), twin(spark, sf)))
    return assign_parents(a, b, "id").agg(
        F.count(F.lit(1)).alias("pairs"), F.count_distinct("parent_id").alias("parents"),
        F.count_distinct("synthetic_id").alias("targets"), r(F.sum("distance"), 3).alias("total"))


@suite.add("m04_link_linear_sum_bound", """
select count(*) as pairs, count(*) as parents, count(*) as targets, true as adds_up, true as near_least from embeddings""")
def m04c(spark, sf):
    """Embeddings and their mirror images: one-to-one, with the distances of its pairs, near what nothing can go below."""
    a = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("features"))
    b = a.withColumn("features", F.reverse("features"))
    out = assign_parents(a, b, "id", block_rows=128)
    bound = assignment_bound(a, b, out, "id", block_rows=128, steps=4)
    far = F.sqrt(F.aggregate(F.zip_with("x", "y", lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, v: s + v))
    pairs = out.join(a.select(F.col("id").alias("parent_id"), F.col("features").alias("x")), "parent_id").join(
        b.select(F.col("id").alias("synthetic_id"), F.col("features").alias("y")), "synthetic_id")
    whole = pairs.agg(
        F.count(F.lit(1)).alias("pairs"), F.count_distinct("parent_id").alias("parents"),
        F.count_distinct("synthetic_id").alias("targets"), F.sum(far).alias("own"))
    return whole.join(F.broadcast(bound)).select(
        "pairs", "parents", "targets", (F.abs(F.col("own") - F.col("total")) < 1e-6).alias("adds_up"),
        (F.col("total") <= 1.05 * F.col("lower_bound")).alias("near_least"))


def _parents(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_size")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return (mt.Parent("customer", customers, "c_custkey", "o_custkey"),
            mt.Parent("part", parts, "p_partkey", "l_partkey"),
            mt.Parent("order", orders, "o_orderkey", "l_orderkey"))


@suite.add("m05_flatten", """
select l_orderkey, l_partkey, l_quantity, p_brand as part_p_brand, p_size as part_p_size,
       o_orderstatus as order_o_orderstatus, o_totalprice as order_o_totalprice
from lineitem left join part on l_partkey = p_partkey left join orders on l_orderkey = o_orderkey""")
def m05(spark, sf):
    _, part, order = _parents(spark, sf)
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return mt.flatten(lines, [part, order])


@suite.add("m06_top_enriched", f"""
with c as (select o_custkey, count(*) as n, avg(o_totalprice) as p from orders group by 1),
s as (select o_custkey, o_orderstatus as v from (select o_custkey, o_orderstatus, row_number() over (partition by o_custkey order by count(*) desc, o_orderstatus) as rk from orders group by 1, 2) where rk = 1),
q as (select o_custkey, o_orderpriority as v from (select o_custkey, o_orderpriority, row_number() over (partition by o_custkey order by count(*) desc, o_orderpriority) as rk from orders group by 1, 2) where rk = 1)
select c_custkey, coalesce(n, 0) as orders_count, {sr('p')} as orders_o_totalprice_mean, s.v as orders_o_orderstatus_mode, q.v as orders_o_orderpriority_mode
from customer left join c on c.o_custkey = c_custkey left join s on s.o_custkey = c_custkey left join q on q.o_custkey = c_custkey""")
def m06(spark, sf):
    out = mt.top_enriched(table(spark, sf, "customer").select("c_custkey"), "c_custkey", [
        ("orders", table(spark, sf, "orders"), "o_custkey", ["o_totalprice", "o_orderstatus", "o_orderpriority"])])
    return out.withColumn("orders_o_totalprice_mean", r("orders_o_totalprice_mean"))


@suite.add("m07_bottom_id", "select o_orderkey, o_custkey, o_totalprice, o_custkey as individual_id from orders")
def m07(spark, sf):
    return mt.bottom_id_propagated(_orders(spark, sf)[0], "o_custkey")


@suite.add("m08_bottom_information", """
select o_orderkey, o_custkey, o_totalprice, o_custkey as individual_id, c_mktsegment as customer_c_mktsegment, c_nationkey as customer_c_nationkey
from orders left join customer on o_custkey = c_custkey""")
def m08(spark, sf):
    return mt.bottom_information_propagated(_orders(spark, sf)[0], _parents(spark, sf)[0])


@suite.add("m09_full_enriched", """
select l_orderkey, l_partkey, l_quantity, l_partkey as individual_id, o_orderstatus as order_o_orderstatus, o_totalprice as order_o_totalprice
from lineitem left join orders on l_orderkey = o_orderkey""")
def m09(spark, sf):
    _, part, order = _parents(spark, sf)
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return mt.full_enriched(lines, part, [part, order])


# -- series ------------------------------------------------------------------------------------

POINTS = 20


def _aligned(spark, sf, method="specified", n=POINTS):
    return ts.align(table(spark, sf, "events"), "user_id", "ts", ["value"], "event_id",
                    method=method, nb_points=n)


def _aligned_sql(n: str) -> str:
    return f"""
e as (select user_id, epoch_us(ts) / 1e6 as t, event_id, value as v from events),
lim as (select user_id, min(t) as lo, max(t) as hi, count(*) as n from e group by 1),
len as (select {n} as k from lim),
g as (select user_id, point, lo + point * ((hi - lo) / (k - 1.0)) as t from lim, len, (select unnest(range(10000)) as point) where point < k),
b as (select g.user_id, point, any_value(g.t) as t,
             max_by(e.t, (e.t, event_id)) filter (e.t <= g.t) as t0, max_by(v, (e.t, event_id)) filter (e.t <= g.t) as v0,
             min_by(e.t, (e.t, event_id)) filter (e.t >= g.t) as t1, min_by(v, (e.t, event_id)) filter (e.t >= g.t) as v1
      from g join e on e.user_id = g.user_id group by 1, 2),
aligned as (select user_id, cast(point as int) as point, t,
  case when v1 is null or t0 = t1 then v0 else v0 + (t - t0) / (t1 - t0) * (v1 - v0) end as v from b)"""


@suite.add("ts01_align_specified", f"""
with {_aligned_sql(f'any_value({POINTS})')} select user_id, point, {sr('t', 3)} as ts, {sr('v', 4)} as value from aligned""")
def ts01(spark, sf):
    return _aligned(spark, sf).withColumns({"ts": r("ts", 3), "value": r("value", 4)})


for _method, _sql in (("max", "max(n)"), ("min", "min(n)"), ("mean", "cast(floor(avg(n) + 0.5) as int)")):
    def _query(spark, sf, method=_method):
        return _aligned(spark, sf, method, None).withColumns({"ts": r("ts", 3), "value": r("value", 4)})

    suite.add(f"ts01_align_{_method}", f"""
with {_aligned_sql(_sql)} select user_id, point, {sr('t', 3)} as ts, {sr('v', 4)} as value from aligned""")(_query)


def _scores(projection):
    def query(spark, sf):
        scores, _ = ts.series_scores(_aligned(spark, sf), "user_id", ["value"], POINTS,
                                     projection=projection, nf=3)
        return scores.select("user_id", *[r(F.col("features")[i]).alias(f"s{i}") for i in range(3)])

    return query


suite.add("ts02_flatten_scores")(_scores("flatten"))
suite.add("ts03_fpca_scores")(_scores("fpca"))


@suite.add("ts03_long_series", """
select count(distinct user_id) as series, true as centred, true as orthogonal, true as falling from events""")
def ts03_long(spark, sf):
    """Series of 12,000 points: variances of the scores fall, their covariances are 0."""
    aligned = _aligned(spark, sf, n=12_000).select("user_id", "point", "value")
    components = ts.fit_series_components(aligned, "user_id", ["value"], 12_000, nf=3, passes=2)
    placed = materialize(components.place(aligned, "user_id").select(
        "user_id", *[F.col("features")[j].alias(f"f{j}") for j in range(3)]))
    row = placed.agg(
        F.count(F.lit(1)).alias("series"), *[F.var_pop(f"f{j}").alias(f"v{j}") for j in range(3)],
        *[F.covar_pop(f"f{i}", f"f{j}").alias(f"c{i}{j}") for i in range(3) for j in range(i)])
    same = F.lit(True)
    for j in range(3):
        same = same & (F.abs(F.col(f"v{j}") - F.lit(float(components.explained[j]))) < 1e-9 * F.col("v0"))
    return row.select(
        "series", same.alias("centred"),
        ((F.abs("c10") < 1e-9 * F.col("v0")) & (F.abs("c20") < 1e-9 * F.col("v0")) & (F.abs("c21") < 1e-9 * F.col("v0"))).alias("orthogonal"),
        ((F.col("v0") >= F.col("v1")) & (F.col("v1") >= F.col("v2")) & (F.col("v2") > 0)).alias("falling"))


def _two_points_sql(weight: str) -> str:
    return f"""
with {_aligned_sql('any_value(2)')},
wide as (select user_id, max(case when point = 0 then v end) * {weight} as a0, max(case when point = 1 then v end) * {weight} as b0
         from aligned group by 1),
z as (select user_id as id, a0 - (select avg(a0) from wide) as zx, b0 - (select avg(b0) from wide) as zy from wide),
{pca_two_sql('z', 'id', 'zx', 'zy')}
select id as user_id, {sr('x1', 4)} as s0, {sr('x2', 4)} as s1 from proj"""


for _projection, _weight in (("flatten", "1.0"), ("fpca", "(1.0 / sqrt(2.0))")):
    def _query(spark, sf, projection=_projection):
        scores, _ = ts.series_scores(_aligned(spark, sf, n=2), "user_id", ["value"], 2,
                                     projection=projection, nf=2)
        at = F.col("features")
        return scores.select("user_id", r(at[0], 4).alias("s0"), r(at[1], 4).alias("s1"))

    suite.add(f"ts0{'2' if _projection == 'flatten' else '3'}_{_projection}_scores_two_points", _two_points_sql(_weight))(_query)


@suite.add("ts04_attach_scores", """
with u as (select user_id, avg(value) as m, stddev_samp(value) as s from events where user_id % 5 <> 0 group by 1)
select c_custkey, round(m, 6) as score_1, round(s, 6) as score_2 from customer left join u on user_id = c_custkey""")
def ts04(spark, sf):
    values = table(spark, sf, "events").where("user_id % 5 <> 0").groupBy("user_id").agg(
        F.array(F.avg("value"), F.stddev_samp("value")).alias("features"))
    out = ts.attach_scores(table(spark, sf, "customer").select("c_custkey"), "c_custkey", values, "user_id", 2)
    return out.withColumns({c: F.round(c, 6) for c in ("score_1", "score_2")})


INDIVIDUAL_SQL = f"""
v as (select user_id as id, round(avg(value), 6) as x, round(count(*) / 10.0, 6) as y from events group by 1),
nn as (select q.id as query_id, d.id as neighbor_id, sqrt((q.x - d.x) * (q.x - d.x) + (q.y - d.y) * (q.y - d.y)) as distance,
             row_number() over (partition by q.id order by (q.x - d.x) * (q.x - d.x) + (q.y - d.y) * (q.y - d.y), d.id) as rk
      from v q, v d where q.id <> d.id),
w as (select query_id, neighbor_id, 1.0 / greatest(distance, 1e-9) * -ln(1.0 - {su(21, 'generate:weight', 'query_id', 'neighbor_id')})
             * pow(2.0, -row_number() over (partition by query_id order by {su(21, 'generate:rank', 'query_id', 'neighbor_id')}, neighbor_id)) as weight
      from nn where rk <= 5)"""


def _joint(spark, sf):
    users = table(spark, sf, "events").groupBy(F.col("user_id").alias("id")).agg(
        F.array(F.round(F.avg("value"), 6), F.round(F.count(F.lit(1)) / 10.0, 6)).alias("features"))
    near = nearest(users, users, 5, query_key="id", candidate_key="id", exclude_self=True)
    return ts.weighted_series(neighbor_weights(near, 21), _aligned(spark, sf), "user_id", ["ts", "value"])


JOINT_SQL = f"""{_aligned_sql(f'any_value({POINTS})')}, {INDIVIDUAL_SQL},
joint_series as (select query_id as user_id, point, sum(weight * t) / sum(weight) as t, sum(weight * v) / sum(weight) as v
      from w join aligned on neighbor_id = aligned.user_id group by 1, 2)"""


@suite.add("ts05_joint_series", f"""
with {JOINT_SQL} select user_id, point, {sr('t', 2)} as ts, {sr('v', 4)} as value from joint_series""")
def ts05(spark, sf):
    return _joint(spark, sf).withColumns({"ts": r("ts", 2), "value": r("value", 4)})


@suite.add("ts06_rebuild", f"""
with {JOINT_SQL} select user_id, point, cast(round(t) as bigint) as seconds, {sr('v', 4)} as value from joint_series""")
def ts06(spark, sf):
    out = ts.rebuild(_joint(spark, sf), "user_id", "ts", table(spark, sf, "events"))
    seconds = F.round(micros("ts") / 1e6).cast("bigint")
    return out.select("user_id", "point", seconds.alias("seconds"), r("value", 4).alias("value"))


@suite.add("ts07_series_metrics_flat", f"""
with {JOINT_SQL},
o as (select user_id as id, list(v order by point) as x from aligned group by 1),
s as (select user_id as id, list(v order by point) as x from joint_series group by 1),
d as (select o.id as id, s.id as other, list_sum(list_transform(list_zip(o.x, s.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as d2 from o, s),
k as (select *, row_number() over (partition by id order by d2, other) as rk from d),
own as (select id, d2 as r2 from d where id = other),
n as (select d.id, count(case when d2 < r2 then 1 end) as n from d join own on d.id = own.id group by 1)
select {sr("(select 100.0 * avg(cast(id <> other as int)) from k where rk = 1)")} as hidden_rate,
       {sr("(select quantile_cont(n, 0.5) from n)")} as local_cloaking""")
def ts07b(spark, sf):
    a = materialize(ts.series_vectors(_aligned(spark, sf), "user_id", ["value"], POINTS, "flatten"))
    b = materialize(ts.series_vectors(_joint(spark, sf), "user_id", ["value"], POINTS, "flatten"))
    return one(spark, hidden_rate=privacy.hidden_rate(a, b, "user_id"),
               local_cloaking=privacy.local_cloaking(a, b, "user_id"))


@suite.add("ts07_series_metrics")
def ts07(spark, sf):
    aligned = materialize(_aligned(spark, sf))
    _, components = ts.series_scores(aligned, "user_id", ["value"], POINTS, nf=3)
    placed = materialize(components.place(_joint(spark, sf), "user_id"))
    originals = materialize(components.place(aligned, "user_id"))
    return one(spark, hidden_rate=privacy.hidden_rate(originals, placed, "user_id"),
               local_cloaking=privacy.local_cloaking(originals, placed, "user_id"))
