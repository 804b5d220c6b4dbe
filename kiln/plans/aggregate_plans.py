"""Aggregations."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from kiln.operators import aggregates as agg
from kiln.plans.registry import query
from kiln.sources.tables import table


def _t(spark, sf_dir, name):
    return table(spark, sf_dir, name)


@query("a1_group_agg_columns", ids=("A1", "A2"), sql="""
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty,
       round(sum(l_extendedprice), 2) AS sum_base_price,
       round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price,
       round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS sum_charge,
       round(avg(l_quantity), 6) AS avg_qty, round(avg(l_discount), 6) AS avg_disc,
       count(*) AS count_order, max(l_tax) AS max_tax, min(l_tax) AS min_tax
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def a1_group_agg_columns(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    disc = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
        F.round(F.sum("l_extendedprice"), 2).alias("sum_base_price"),
        F.round(F.sum(disc), 2).alias("sum_disc_price"),
        F.round(F.sum(disc * (1 + F.col("l_tax"))), 2).alias("sum_charge"),
        F.round(F.avg("l_quantity"), 6).alias("avg_qty"), F.round(F.mean("l_discount"), 6).alias("avg_disc"),
        F.count(F.lit(1)).alias("count_order"), F.max("l_tax").alias("max_tax"), F.min("l_tax").alias("min_tax"))


@query("a1_group_dict_and_shortcuts", ids=("A1",), sql="""
SELECT l_returnflag, max(l_quantity) AS max_qty, count(*) AS count, min(l_tax) AS min_tax,
       round(avg(l_quantity), 6) AS mean_qty, round(sum(l_discount), 4) AS sum_disc, max(l_discount) AS max_disc
FROM lineitem GROUP BY l_returnflag""")
def a1_group_dict_and_shortcuts(spark, sf_dir):
    g = _t(spark, sf_dir, "lineitem").groupBy("l_returnflag")
    return g.agg(F.max("l_quantity").alias("max_qty"), F.count(F.lit(1)).alias("count"), F.min("l_tax").alias("min_tax"),
                 F.round(F.mean("l_quantity"), 6).alias("mean_qty"), F.round(F.sum("l_discount"), 4).alias("sum_disc"),
                 F.max("l_discount").alias("max_disc"))


@query("a2_aggregates_skip_nulls", ids=("A2",), sql="""
WITH x AS (SELECT l_returnflag, nullif(l_linenumber, 1) AS q FROM lineitem)
SELECT l_returnflag, count(q) AS cnt, count(*) AS cnt_all, CAST(sum(q) AS BIGINT) AS sum_q,
       round(avg(q), 6) AS avg_q, min(q) AS min_q, max(q) AS max_q
FROM x GROUP BY l_returnflag""")
def a2_aggregates_skip_nulls(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    x = li.select("l_returnflag", F.nullif(F.col("l_linenumber"), F.lit(1)).alias("q"))
    return x.groupBy("l_returnflag").agg(F.count("q").alias("cnt"), F.count(F.lit(1)).alias("cnt_all"),
                                         F.sum("q").alias("sum_q"), F.round(F.avg("q"), 6).alias("avg_q"),
                                         F.min("q").alias("min_q"), F.max("q").alias("max_q"))


@query("a3_first_last_by_order", ids=("A3",), sql="""
SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order,
       arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order
FROM orders GROUP BY o_custkey""")
def a3_first_last_by_order(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    ordk = F.struct("o_orderdate", "o_orderkey")
    return o.groupBy("o_custkey").agg(F.min_by("o_orderkey", ordk).alias("first_order"),
                                      F.max_by("o_orderkey", ordk).alias("last_order"))


@query("a4_distinct_aggregates", ids=("A4",), sql="""
SELECT l_returnflag, sum(DISTINCT l_quantity) AS sum_distinct_qty,
       count(DISTINCT l_suppkey) AS n_suppliers, count(DISTINCT (l_suppkey, l_linenumber)) AS n_supp_line
FROM lineitem GROUP BY l_returnflag""")
def a4_distinct_aggregates(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return li.groupBy("l_returnflag").agg(F.sum_distinct("l_quantity").alias("sum_distinct_qty"),
                                          F.countDistinct("l_suppkey").alias("n_suppliers"),
                                          F.count_distinct("l_suppkey", "l_linenumber").alias("n_supp_line"))


@query("a4_count_by_value", ids=("A4",), sql="""
SELECT o_orderpriority AS value, count(*) AS count FROM orders GROUP BY 1""")
def a4_count_by_value(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_orderpriority").alias("value")).count()


@query("a5_approx_count_distinct", ids=("A5",), sql="""
SELECT l_returnflag, count(DISTINCT l_partkey) AS exact_parts, true AS near FROM lineitem GROUP BY 1""")
def a5_approx_count_distinct(spark, sf_dir):
    """The estimate lies within four of its relative deviations (0.05)."""
    li = _t(spark, sf_dir, "lineitem")
    x = li.groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey", 0.05).alias("approx_parts"),
                                       F.count_distinct("l_partkey").alias("exact_parts"))
    return x.select("l_returnflag", "exact_parts", (F.abs(F.col("approx_parts") - F.col("exact_parts")) <= 0.2 * F.col("exact_parts") + 1).alias("near"))


@query("a6_rollup", ids=("A6",), sql="""
SELECT l_returnflag, l_linestatus, CAST(grouping_id(l_returnflag, l_linestatus) AS BIGINT) AS gid,
       count(*) AS n, round(sum(l_quantity), 2) AS qty
FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def a6_rollup(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return li.rollup("l_returnflag", "l_linestatus").agg(
        F.grouping_id().cast("long").alias("gid"), F.count(F.lit(1)).alias("n"),
        F.round(F.sum("l_quantity"), 2).alias("qty"))


@query("a6_cube", ids=("A6",), sql="""
SELECT o_orderstatus, o_orderpriority, CAST(grouping_id(o_orderstatus, o_orderpriority) AS BIGINT) AS gid,
       count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
def a6_cube(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.cube("o_orderstatus", "o_orderpriority").agg(F.grouping_id().cast("long").alias("gid"),
                                                          F.count(F.lit(1)).alias("n"))


@query("a6_grouping_sets_sql", ids=("A6", "S7"), sql="""
SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders
GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())""")
def a6_grouping_sets_sql(spark, sf_dir):
    _t(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    return spark.sql("""SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders
                        GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())""")


@query("a7_global_aggregates", ids=("A7",), sql="""
SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total, round(avg(o_totalprice), 6) AS mean,
       max(o_totalprice) AS max_price, min(o_totalprice) AS min_price FROM orders""")
def a7_global_aggregates(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"),
                 F.round(F.avg("o_totalprice"), 6).alias("mean"), F.max("o_totalprice").alias("max_price"),
                 F.min("o_totalprice").alias("min_price"))


@query("a8_stat_counter", ids=("A8",), sql="""
SELECT l_returnflag, count(l_quantity) AS n, round(avg(l_quantity), 6) AS mean,
       round(var_pop(l_quantity), 6) AS variance, round(var_samp(l_quantity), 6) AS sample_variance,
       round(stddev_pop(l_quantity), 6) AS stdev, round(stddev_samp(l_quantity), 6) AS sample_stdev,
       min(l_quantity) AS min, max(l_quantity) AS max
FROM lineitem GROUP BY l_returnflag""")
def a8_stat_counter(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    q = F.col("l_quantity")
    return li.groupBy("l_returnflag").agg(
        F.count(q).alias("n"), F.round(F.avg(q), 6).alias("mean"), F.round(F.var_pop(q), 6).alias("variance"),
        F.round(F.var_samp(q), 6).alias("sample_variance"), F.round(F.stddev_pop(q), 6).alias("stdev"),
        F.round(F.stddev_samp(q), 6).alias("sample_stdev"), F.min(q).alias("min"), F.max(q).alias("max"))


@query("a9_histogram_even", ids=("A9",), sql="""
WITH mm AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
b AS (SELECT list_concat(list_transform(range(10), lambda i: lo + i * ((hi - lo) / 10)), [hi]) AS bounds FROM mm),
idx AS (SELECT CASE WHEN o_totalprice = bounds[11] THEN 9
                    ELSE len(list_filter(bounds, lambda v: v <= o_totalprice)) - 1 END AS bucket FROM orders, b),
c AS (SELECT bucket, count(*) AS n FROM idx GROUP BY bucket)
SELECT CAST(r.i AS INTEGER) AS bucket, b.bounds[r.i + 1] AS lo, b.bounds[r.i + 2] AS hi, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM range(10) r(i) CROSS JOIN b LEFT JOIN c ON c.bucket = r.i""")
def a9_histogram_even(spark, sf_dir):
    return agg.histogram(_t(spark, sf_dir, "orders"), "o_totalprice", 10)


@query("a9_histogram_boundaries", ids=("A9",), sql="""
WITH b AS (SELECT [0.0, 50000.0, 100000.0, 200000.0, 300000.0]::DOUBLE[] AS bounds),
idx AS (SELECT CASE WHEN o_totalprice = 300000.0 THEN 3
                    ELSE len(list_filter(bounds, lambda v: v <= o_totalprice)) - 1 END AS bucket
        FROM orders, b WHERE o_totalprice >= 0 AND o_totalprice <= 300000.0),
c AS (SELECT bucket, count(*) AS n FROM idx GROUP BY bucket)
SELECT CAST(r.i AS INTEGER) AS bucket, b.bounds[r.i + 1] AS lo, b.bounds[r.i + 2] AS hi, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM range(4) r(i) CROSS JOIN b LEFT JOIN c ON c.bucket = r.i""")
def a9_histogram_boundaries(spark, sf_dir):
    return agg.histogram(_t(spark, sf_dir, "orders"), "o_totalprice", [0, 50000, 100000, 200000, 300000])


@query("a10_describe_population_std", ids=("A10",), sql="""
SELECT * FROM (
  SELECT 'count' AS summary, 'l_quantity' AS column, CAST(count(l_quantity) AS DOUBLE) AS value FROM lineitem
  UNION ALL SELECT 'mean', 'l_quantity', round(avg(l_quantity), 6) FROM lineitem
  UNION ALL SELECT 'stddev', 'l_quantity', round(stddev_pop(l_quantity), 6) FROM lineitem
  UNION ALL SELECT 'min', 'l_quantity', min(l_quantity) FROM lineitem
  UNION ALL SELECT 'max', 'l_quantity', max(l_quantity) FROM lineitem
  UNION ALL SELECT 'count', 'l_discount', CAST(count(l_discount) AS DOUBLE) FROM lineitem
  UNION ALL SELECT 'mean', 'l_discount', round(avg(l_discount), 6) FROM lineitem
  UNION ALL SELECT 'stddev', 'l_discount', round(stddev_pop(l_discount), 6) FROM lineitem
  UNION ALL SELECT 'min', 'l_discount', min(l_discount) FROM lineitem
  UNION ALL SELECT 'max', 'l_discount', max(l_discount) FROM lineitem)""")
def a10_describe_population_std(spark, sf_dir):
    return agg.describe_long(_t(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount"])


@query("a11_corr_cov", ids=("A11",), sql="""
SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 8) AS pearson,
       round(covar_samp(l_quantity, l_extendedprice), 4) AS cov
FROM lineitem GROUP BY l_returnflag""")
def a11_corr_cov(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return li.groupBy("l_returnflag").agg(F.round(F.corr("l_quantity", "l_extendedprice"), 8).alias("pearson"),
                                          F.round(F.covar_samp("l_quantity", "l_extendedprice"), 4).alias("cov"))


@query("a12_crosstab", ids=("A12",), sql="""
SELECT l_returnflag AS l_returnflag_l_linestatus, count(*) FILTER (WHERE l_linestatus = 'F') AS "F",
       count(*) FILTER (WHERE l_linestatus = 'O') AS "O"
FROM lineitem GROUP BY l_returnflag""")
def a12_crosstab(spark, sf_dir):
    return agg.crosstab(_t(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus")


@query("a12_crosstab_long_nulls", ids=("A12",), sql="""
SELECT l_returnflag, nullif(l_linenumber, 3) AS line, count(*) AS n FROM lineitem GROUP BY 1, 2""")
def a12_crosstab_long_nulls(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_returnflag", F.nullif(F.col("l_linenumber"), F.lit(3)).alias("line"))
    return agg.crosstab_long(li, "l_returnflag", "line")


@query("a13_freq_items_sketch", ids=("A13",), sql="""
SELECT true AS has_all_frequent_status, true AS has_all_frequent_priority, true AS within_bound""")
def a13_freq_items_sketch(spark, sf_dir):
    """The sketch lists every value with more than the support, and at most
    1 / support of them; which others it lists is left open."""
    support = 0.3
    o = _t(spark, sf_dir, "orders")
    found = o.stat.freqItems(["o_orderstatus", "o_orderpriority"], support)
    frequent = {c: [r[c] for r in agg.frequent_values(o, c, support).collect()]           # at most 1 / support values
                for c in ("o_orderstatus", "o_orderpriority")}

    def lists_all(c):
        return F.size(F.array_except(F.array(*map(F.lit, frequent[c])), F.col(f"{c}_freqItems"))) == 0

    bound = F.lit(1 / support)
    return found.select(lists_all("o_orderstatus").alias("has_all_frequent_status"),
                        lists_all("o_orderpriority").alias("has_all_frequent_priority"),
                        ((F.size("o_orderstatus_freqItems") <= bound) & (F.size("o_orderpriority_freqItems") <= bound)).alias("within_bound"))


@query("a13_frequent_values_exact", ids=("A13",), sql="""
SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1
HAVING count(*) >= 0.2 * (SELECT count(*) FROM orders)""")
def a13_frequent_values_exact(spark, sf_dir):
    return agg.frequent_values(_t(spark, sf_dir, "orders"), "o_orderpriority", 0.2)


@query("a14_reduce_by_key_monoid", ids=("A14",), sql="""
SELECT l_suppkey, max(l_quantity) AS l_quantity FROM lineitem GROUP BY l_suppkey""")
def a14_reduce_by_key_monoid(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return li.groupBy("l_suppkey").agg(F.max("l_quantity").alias("l_quantity"))


@query("a14_reduce_by_key_user_monoid", ids=("A14",), sql="""
SELECT l_suppkey, round(ln(sum(exp(l_quantity))), 6) AS l_quantity FROM lineitem GROUP BY l_suppkey""")
def a14_reduce_by_key_user_monoid(spark, sf_dir):
    """log(exp(a) + exp(b)), which no built-in aggregate has."""
    li = _t(spark, sf_dir, "lineitem")
    return agg.keyed_reduce(li, "l_suppkey", "l_quantity", np.logaddexp).select("l_suppkey", F.round("l_quantity", 6).alias("l_quantity"))


@query("a14_combine_by_key_mean", ids=("A14",), sql="""
SELECT l_suppkey, count(*) AS n, round(sum(l_quantity), 2) AS total, round(avg(l_quantity), 6) AS mean
FROM lineitem GROUP BY l_suppkey""")
def a14_combine_by_key_mean(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    g = li.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("_s"))
    return g.select("l_suppkey", "n", F.round("_s", 2).alias("total"), F.round(F.col("_s") / F.col("n"), 6).alias("mean"))


@query("a15_group_by_key_long", ids=("A15",), sql="""
SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS pos FROM orders""")
def a15_group_by_key_long(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return agg.grouped_values(o, "o_custkey", "o_orderkey")


@query("a16_vector_sum", ids=("A16",), sql="""
SELECT CAST(pos AS INTEGER) AS pos, round(sum(v), 3) AS total FROM (
  SELECT generate_subscripts(embedding, 1) - 1 AS pos, unnest(embedding) AS v FROM embeddings) GROUP BY pos""")
def a16_vector_sum(spark, sf_dir):
    e = _t(spark, sf_dir, "embeddings")
    x = e.select(F.posexplode("embedding").alias("pos", "v"))
    return x.groupBy("pos").agg(F.round(F.sum(F.col("v").cast("double")), 3).alias("total"))


@query("a16_tree_aggregate", ids=("A16",), sql="""
SELECT round(sum(l_quantity), 2) AS total, count(l_quantity) AS n, min(l_discount) AS lo, max(l_discount) AS hi
FROM lineitem""")
def a16_tree_aggregate(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    t = agg.tree_aggregate(li, [("total", "sum", "l_quantity"), ("n", "count", "l_quantity"),
                                ("lo", "min", "l_discount"), ("hi", "max", "l_discount")], fanout=4)
    return t.select(F.round("total", 2).alias("total"), "n", "lo", "hi")


@query("a17_approximate_estimates", ids=("A17",), sql="""
SELECT unnest(['count', 'sum', 'mean']) AS stat, true AS ordered, true AS near_exact""")
def a17_approximate_estimates(spark, sf_dir):
    """Estimates from a sample: the interval holds the estimate, and the exact
    figure lies within three widths of it."""
    li = _t(spark, sf_dir, "lineitem")
    est = agg.clt_estimate(li, "l_quantity", 0.1, seed=1)
    exact = li.agg(F.count("l_quantity").cast("double").alias("count"), F.sum("l_quantity").alias("sum"), F.avg("l_quantity").alias("mean"))
    exact = exact.selectExpr("stack(3, 'count', `count`, 'sum', `sum`, 'mean', `mean`) AS (stat, exact)")
    width = F.col("high") - F.col("low")
    return est.join(exact, "stat").select(
        "stat", ((F.col("low") < F.col("estimate")) & (F.col("estimate") < F.col("high"))).alias("ordered"),
        F.col("exact").between(F.col("low") - 3 * width, F.col("high") + 3 * width).alias("near_exact"))
