"""Profiles, splits and the relational operators around processors and synthesis."""

from __future__ import annotations


from pyspark.sql import functions as F

from checks.common import Suite, r, sr, su, table
from maskloom.operators.histogram import histogram, histogram_2d
from maskloom.operators.profile import (
    categorical_columns,
    distinct_counts,
    grouped_mean_std,
    identifier_columns,
    modality_counts,
    numeric_under_threshold,
)
from maskloom.operators.quantiles import exact_quantiles, grouped_quantiles
from maskloom.operators.relational import (
    attach_range,
    downsample_series,
    order_by_categories,
    sample_with_replacement,
    shuffled,
    symmetric_difference,
    value_count_difference,
    value_counts,
)
from maskloom.operators.split import batch_parts, first_occurrences
from maskloom.sources.tables import read_table

suite = Suite()


@suite.add("s02_parquet_scan", """
select o_orderkey, o_orderpriority, o_totalprice from orders where o_orderstatus = 'F'""")
def s02(spark, sf):
    df = read_table(spark, f"{sf}/orders.parquet")
    return df.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderpriority", "o_totalprice")


LINE = ["l_linenumber", "l_tax", "l_discount", "l_quantity", "l_extendedprice", "l_shipdate"]


@suite.add("t03_numeric_under_threshold", " union all ".join(
    f"select '{c}' as name from (select count(distinct {c}) as n from lineitem) where n <= 50" for c in LINE))
def t03(spark, sf):
    df = table(spark, sf, "lineitem").select(*LINE)
    names = numeric_under_threshold(df, threshold=50)
    return spark.createDataFrame([(c,) for c in names], "name string")


PART_TEXT = ["p_name", "p_brand", "p_type"]


@suite.add("t04_distinct_counts", " union all ".join(
    f"select '{c}' as \"column\", count(distinct {c}) as n_unique from part" for c in PART_TEXT))
def t04(spark, sf):
    df = table(spark, sf, "part")
    return distinct_counts(df, categorical_columns(df))


@suite.add("t05_modality_counts", " union all ".join(
    f"select '{c}' as \"column\", {c} as value, count(*) as n from lineitem group by 2"
    for c in ("l_returnflag", "l_linestatus")))
def t05(spark, sf):
    return modality_counts(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])


@suite.add("t06_grouped_mean_std", f"""
select l_returnflag, l_linestatus, {sr("avg(l_quantity)")} as l_quantitymean,
       {sr("stddev_samp(l_quantity)")} as l_quantitystd from lineitem group by 1, 2""")
def t06(spark, sf):
    out = grouped_mean_std(table(spark, sf, "lineitem"), ["l_quantity"], ["l_returnflag", "l_linestatus"])
    return out.withColumns({c: r(c) for c in ("l_quantitymean", "l_quantitystd")})


IDS = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]


@suite.add("a18_identifier_columns", " union all ".join(
    f"select '{c}' as \"column\", count(distinct {c}) as n_unique, count({c}) as n_present, "
    f"count(*) as n_rows, count(distinct {c}) = count(*) and count({c}) = count(*) as is_identifier from customer"
    for c in IDS))
def a18(spark, sf):
    return identifier_columns(table(spark, sf, "customer"))


# -- split -------------------------------------------------------------------------------------

FIRST_SQL = """
select min(p_partkey) as k from part group by p_name
union select min(p_partkey) from part group by p_brand
union select min(p_partkey) from part group by p_type"""


@suite.add("l3_first_occurrences", f"""
select p_partkey, p_name, p_brand, p_type from part where p_partkey in ({FIRST_SQL})""")
def l3(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", *PART_TEXT)
    return first_occurrences(df, PART_TEXT, "p_partkey")


@suite.add("l4_batch_parts", f"""
with f as ({FIRST_SQL}),
     o as (select p_partkey, row_number() over (
             order by case when p_partkey in (select k from f) then 0 else 1 end,
                      case when p_partkey in (select k from f) then 0
                           else {su(9, 'batch', 'p_partkey')} end, p_partkey) - 1 as pos from part),
     n as (select count(*) as n, cast(ceil(count(*) / 300.0) as bigint) as k from part)
select p_partkey, cast(case when pos < (n % k) * (n // k + 1) then pos // (n // k + 1)
       else n % k + (pos - (n % k) * (n // k + 1)) // (n // k) end as int) as part from o, n""")
def l4(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", *PART_TEXT)
    return batch_parts(df, PART_TEXT, "p_partkey", row_limit=300, seed=9).select("p_partkey", "part")


# -- relational --------------------------------------------------------------------------------

@suite.add("r01_projection", "select c_custkey, c_mktsegment from customer")
def r01(spark, sf):
    return table(spark, sf, "customer").drop("c_name", "c_nationkey", "c_acctbal")


@suite.add("r02_limit", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 25")
def r02(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return df.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@suite.add("r03_filter", """
select l_orderkey, l_partkey, l_quantity from lineitem
where l_discount between 0.02 and 0.04 and l_returnflag = 'R'""")
def r03(spark, sf):
    mask = F.col("l_discount").between(0.02, 0.04) & (F.col("l_returnflag") == "R")
    return table(spark, sf, "lineitem").where(mask).select("l_orderkey", "l_partkey", "l_quantity")


@suite.add("r04_derived_column", f"""
select l_orderkey, l_partkey, {sr("l_extendedprice * (1 - l_discount) * (1 + l_tax)")} as charge from lineitem""")
def r04(spark, sf):
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", r(charge).alias("charge"))


@suite.add("r05_value_counts", "select event_type, count(*) as n from events group by 1")
def r05(spark, sf):
    return value_counts(table(spark, sf, "events"), "event_type")


@suite.add("r06_value_count_difference", """
with a as (select p_size, count(*) as n from part where p_type <> 'SMALL' group by 1),
     b as (select p_size, count(*) as n from part where p_type = 'SMALL' group by 1)
select coalesce(a.p_size, b.p_size) as p_size, a.n - b.n as difference
from a full join b on a.p_size = b.p_size""")
def r06(spark, sf):
    df = table(spark, sf, "part")
    return value_count_difference(df.where("p_type <> 'SMALL'"), df.where("p_type = 'SMALL'"), "p_size")


@suite.add("r07_grouped_mean", f"""
select c_mktsegment, {sr("avg(c_acctbal)")} as c_acctbal, {sr("avg(c_nationkey)")} as c_nationkey
from customer group by 1""")
def r07(spark, sf):
    return table(spark, sf, "customer").groupBy("c_mktsegment").agg(
        r(F.avg("c_acctbal")).alias("c_acctbal"), r(F.avg("c_nationkey")).alias("c_nationkey"))


@suite.add("r08_conditional_count", """
select count(*) filter (l_tax > l_discount) as more, count(*) filter (l_tax < l_discount) as less from lineitem""")
def r08(spark, sf):
    tax, discount = F.col("l_tax"), F.col("l_discount")
    return table(spark, sf, "lineitem").agg(
        F.count_if(tax > discount).alias("more"), F.count_if(tax < discount).alias("less"))


@suite.add("r09_linear_residual", f"""
with s as (select l_orderkey, sum(l_extendedprice) as p from lineitem group by 1)
select {sr("max(abs(o_totalprice - p))", 4)} as residual from orders join s on l_orderkey = o_orderkey""")
def r09(spark, sf):
    sums = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_extendedprice").alias("p"))
    joined = table(spark, sf, "orders").join(sums, "o_orderkey")
    return joined.agg(r(F.max(F.abs(F.col("o_totalprice") - F.col("p"))), 4).alias("residual"))


@suite.add("r10_left_join_parents", """
select o_orderkey, c_mktsegment as segment, n_name as nation
from orders left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey""")
def r10(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"), "c_nationkey")
    nations = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"))
    joined = table(spark, sf, "orders").join(customers, "o_custkey", "left")
    return joined.join(nations, "c_nationkey", "left").select("o_orderkey", "segment", "nation")


@suite.add("r11_null_safe_join", """
with a as (select c_custkey, nullif(c_mktsegment, 'BUILDING') as s from customer),
     b as (select s, count(*) as n from a group by 1)
select c_custkey, b.n as n from a join b on a.s is not distinct from b.s""")
def r11(spark, sf):
    segment = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    a = table(spark, sf, "customer").select("c_custkey", segment.alias("s"))
    b = a.groupBy(F.col("s").alias("t")).agg(F.count(F.lit(1)).alias("n"))
    return a.join(b, F.col("s").eqNullSafe(F.col("t"))).select("c_custkey", "n")


PRIORITIES = ["5-LOW", "1-URGENT", "3-MEDIUM", "2-HIGH"]


@suite.add("r12_category_order", """
with c as (select o_orderpriority, count(*) as n from orders group by 1)
select o_orderpriority, n, row_number() over (order by case o_orderpriority when '5-LOW' then 1
  when '1-URGENT' then 2 when '3-MEDIUM' then 3 when '2-HIGH' then 4 else 5 end, o_orderpriority) as place from c""")
def r12(spark, sf):
    counts = value_counts(table(spark, sf, "orders"), "o_orderpriority")
    ordered = order_by_categories(counts, "o_orderpriority", PRIORITIES, "o_orderpriority")
    # a handful of grouped rows: their order is made visible as a column
    listed = ordered.agg(F.collect_list(F.struct("o_orderpriority", "n")).alias("x"))
    out = listed.select(F.posexplode("x").alias("i", "x"))
    return out.select("x.o_orderpriority", "x.n", (F.col("i") + 1).cast("bigint").alias("place"))


@suite.add("r13_two_way_counts", """
select o_orderstatus, o_orderpriority, count(*) as n from orders group by 1, 2""")
def r13(spark, sf):
    df = table(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority")
    return df.agg(F.count(F.lit(1)).alias("n"))


@suite.add("r14_box_statistics", f"""
select o_orderpriority, {sr("quantile_cont(o_totalprice, 0.25)")} as q0,
       {sr("quantile_cont(o_totalprice, 0.5)")} as q1, {sr("quantile_cont(o_totalprice, 0.75)")} as q2
from orders group by 1""")
def r14(spark, sf):
    df = table(spark, sf, "orders")
    out = grouped_quantiles(df, ["o_orderpriority"], "o_totalprice", [0.25, 0.5, 0.75])
    return out.withColumns({c: r(c) for c in ("q0", "q1", "q2")})


@suite.add("r14_quantiles", f"""
select {sr("quantile_cont(l_extendedprice, 0.05)")} as q05, {sr("quantile_cont(l_extendedprice, 0.5)")} as q50,
       {sr("quantile_cont(l_extendedprice, 0.99)")} as q99 from lineitem""")
def r14b(spark, sf):
    q = exact_quantiles(table(spark, sf, "lineitem"), "l_extendedprice", [0.05, 0.5, 0.99])
    out = spark.createDataFrame([tuple(q)], "q05 double, q50 double, q99 double")
    return out.select(*[r(c).alias(c) for c in out.columns])


def _bin_sql(x: str, lo: str, hi: str, n: int) -> str:
    raw = f"greatest(least(cast(floor(({x} - {lo}) / ({hi} - {lo}) * {n}.0) as int), {n - 1}), 0)"
    edge = lambda i: f"(case when {i} >= {n} then {hi} else {i} * (({hi} - {lo}) / {n}.0) + {lo} end)"
    return (f"({raw} + case when {x} < {edge(raw)} and {raw} > 0 then -1 "
            f"when {x} >= {edge(f'({raw} + 1)')} and {raw} < {n - 1} then 1 else 0 end)")


@suite.add("r15_density_2d", f"""
with l as (select min(l_quantity)::double as a, max(l_quantity)::double as b, min(l_extendedprice) as c,
                  max(l_extendedprice) as d from lineitem)
select {_bin_sql('l_quantity', 'a', 'b', 12)} as x_bin, {_bin_sql('l_extendedprice', 'c', 'd', 12)} as y_bin,
       count(*) as n from lineitem, l group by 1, 2""")
def r15(spark, sf):
    return histogram_2d(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", 12)


@suite.add("r16_bootstrap", f"""
select c_custkey, c_acctbal, cast(unnest(range(1, copies + 1)) as int) as copy from (
  select c_custkey, c_acctbal, (select count(*) from range(0, 20) t(n) where {su(4, 'bootstrap', 'c_custkey')} >=
    list_sum(list_transform(range(0, n + 1), lambda k: exp(-1) / factorial(k::int)))) as copies from customer)""")
def r16(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return sample_with_replacement(df, "c_custkey", 1.0, seed=4)


@suite.add("r16_shuffle", f"""
select c_custkey, row_number() over (order by {su(4, 'shuffle', 'c_custkey')}, c_custkey) - 1 as place from customer""")
def r16b(spark, sf):
    from maskloom.operators.ordinal import hash_ordinal

    df = table(spark, sf, "customer").select("c_custkey")
    return hash_ordinal(shuffled(df, "c_custkey", 4), "c_custkey", seed=4, stream="shuffle", output="place")


@suite.add("r17_union", """
select c_name as name, c_acctbal as balance from customer union all select s_name, s_acctbal from supplier""")
def r17(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    s = table(spark, sf, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    return c.unionByName(s)


@suite.add("r18_key_difference", """
select c_custkey as k, 'left' as side from customer where c_custkey not in (select o_custkey from orders)
union all select distinct o_custkey, 'right' from orders where o_custkey not in (select c_custkey from customer)""")
def r18(spark, sf):
    left = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    right = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    return symmetric_difference(left, right, "k")


@suite.add("r19_analytic", f"""
select event_id, first_value(value) over w as first_value, lag(value) over w as previous,
       {sr("sum(value) over w")} as running
from events window w as (partition by user_id order by ts, event_id)""")
def r19(spark, sf):
    from maskloom.operators.scan import scan

    df = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    out = scan(df, ["user_id"], ["ts", "event_id"], first={"first_value": "value"},
               lag={"previous": "value"}, cumsum={"running": "value"})
    return out.select("event_id", "first_value", "previous", r("running").alias("running"))


@suite.add("r20_global_range", """
select p_partkey, lo, hi from part, (select min(p_retailprice) as lo, max(p_retailprice) as hi from part)""")
def r20(spark, sf):
    return attach_range(table(spark, sf, "part"), "p_retailprice", "lo", "hi").select("p_partkey", "lo", "hi")


@suite.add("r21_downsample_series", """
with o as (select event_id, user_id, row_number() over (partition by user_id order by ts, event_id) - 1 as pos,
                  count(*) over (partition by user_id) as n from events),
     p as (select user_id, n, cast(floor(0.3 * n) as bigint) as m from o group by 1, 2),
     j as (select user_id, case when j = m - 1 and m > 1 then n - 1
                  else cast(floor(j * ((n - 1) / (m - 1))) as bigint) end as pos
           from (select *, unnest(range(m)) as j from p))
select event_id, o.user_id as user_id from o join (select distinct user_id, pos from j) k on o.user_id = k.user_id and o.pos = k.pos""")
def r21(spark, sf):
    df = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return downsample_series(df, "user_id", "ts", "event_id", 0.3).select("event_id", "user_id")


@suite.add("r22_histogram", f"""
with l as (select min(value) as a, max(value) as b from events),
     h as (select {_bin_sql('value', 'a', 'b', 20)} as bin, a, b, count(*) as n from events, l group by 1, 2, 3)
select bin, {sr("bin * ((b - a) / 20.0) + a")} as lower,
       {sr("case when bin = 19 then b else (bin + 1) * ((b - a) / 20.0) + a end")} as upper, n from h""")
def r22(spark, sf):
    out = histogram(table(spark, sf, "events"), "value", 20)
    return out.withColumns({"lower": r("lower"), "upper": r("upper")})


@suite.add("r19_analytic_with_nulls", """
with e as (select event_id, user_id, ts, case when event_id % 7 < 3 then null else cast(round(value * 100) as bigint) end as v
           from events)
select event_id, sum(v) over (order by ts, event_id rows unbounded preceding) as running from e""")
def r19b(spark, sf):
    from maskloom.operators.scan import scan

    v = F.when(F.col("event_id") % 7 >= 3, F.round(F.col("value") * 100).cast("bigint"))
    df = table(spark, sf, "events").select("event_id", "ts", v.alias("v"), F.lit(1).alias("g"))
    out = scan(df, ["g"], ["ts", "event_id"], cumsum={"running": "v"}, max_group_rows=1000)
    return out.select("event_id", "running")
