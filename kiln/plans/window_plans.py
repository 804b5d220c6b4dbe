"""Window functions (W1-W5), computed with the skew-safe operators of
kiln.operators.windows; DuckDB twins use plain OVER clauses."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import windows as win
from kiln.plans.registry import query
from kiln.sources.tables import table


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice",
                                                  "o_orderpriority")


@query("w1_running_sum_per_key", ids=("W1", "W2"), sql="""
SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS running_total FROM orders""")
def w1_running_sum_per_key(spark, sf_dir):
    o = _orders(spark, sf_dir)
    r = win.running(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice", "sum", "running_total")
    return r.select("o_orderkey", F.round("running_total", 2).alias("running_total"))


@query("w2_moving_average_rows", ids=("W2",), sql="""
SELECT o_orderkey, round(avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
       ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS moving_avg FROM orders""")
def w2_moving_average_rows(spark, sf_dir):
    o = _orders(spark, sf_dir)
    r = win.rows_frame(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice", -2, 0, "avg", "moving_avg")
    return r.select("o_orderkey", F.round("moving_avg", 4).alias("moving_avg"))


@query("w2_wide_rows_frame", ids=("W2",), sql="""
SELECT l_orderkey, l_linenumber, l_suppkey, round(sum(l_quantity) OVER w, 2) AS total, count(*) OVER w AS n, max(l_quantity) OVER w AS most
FROM lineitem WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity, l_extendedprice
                           ROWS BETWEEN 500 PRECEDING AND 20 FOLLOWING)""")
def w2_wide_rows_frame(spark, sf_dir):
    """Frames of 521 rows in three large groups."""
    li = table(spark, sf_dir, "lineitem")
    order = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "l_extendedprice"]
    r = win.rows_frames(li.select("l_returnflag", *order), ["l_returnflag"], order, "l_quantity", -500, 20, {"total": "sum", "n": "count", "most": "max"})
    return r.select("l_orderkey", "l_linenumber", "l_suppkey", F.round("total", 2).alias("total"), "n", "most")


@query("w2_range_frame_days", ids=("W2",), sql="""
WITH x AS (SELECT o_orderkey, o_custkey, CAST(datediff('day', DATE '1990-01-01', o_orderdate) AS INTEGER) AS day_no,
                  o_totalprice FROM orders)
SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey ORDER BY day_no RANGE BETWEEN 365 PRECEDING AND CURRENT ROW)
       AS orders_last_year FROM x""")
def w2_range_frame_days(spark, sf_dir):
    o = _orders(spark, sf_dir).withColumn("day_no", F.datediff(F.to_date("o_orderdate"), F.lit("1990-01-01").cast("date")))
    r = win.range_frame(o, ["o_custkey"], "day_no", "o_orderkey", -365, 0, "count", "orders_last_year")
    return r.select("o_orderkey", "orders_last_year")


@query("w3_ranking_functions", ids=("W3",), sql="""
SELECT o_orderkey, row_number() OVER w AS row_number, rank() OVER w2 AS rank, dense_rank() OVER w2 AS dense_rank,
       round(percent_rank() OVER w2, 8) AS percent_rank, round(cume_dist() OVER w2, 8) AS cume_dist,
       CAST(ntile(4) OVER w AS INTEGER) AS ntile
FROM (SELECT o_orderkey, o_orderpriority, round(o_totalprice, -4) AS price_band FROM orders)
WINDOW w AS (PARTITION BY o_orderpriority ORDER BY price_band, o_orderkey),
       w2 AS (PARTITION BY o_orderpriority ORDER BY price_band)""")
def w3_ranking_functions(spark, sf_dir):
    o = _orders(spark, sf_dir).select("o_orderkey", "o_orderpriority",
                                      F.round("o_totalprice", -4).alias("price_band"))
    r = win.ranks(o, ["o_orderpriority"], ["price_band"], ["o_orderkey"], ntile=4)
    return r.select("o_orderkey", F.col("row_number").cast("long").alias("row_number"),
                    F.col("rank").cast("long").alias("rank"), F.col("dense_rank").cast("long").alias("dense_rank"),
                    F.round("percent_rank", 8).alias("percent_rank"), F.round("cume_dist", 8).alias("cume_dist"),
                    "ntile")


@query("w4_lag_lead", ids=("W4",), sql="""
SELECT o_orderkey, lag(o_totalprice, 1, 0.0) OVER w AS lag_price, lead(o_orderkey, 2) OVER w AS lead_key
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def w4_lag_lead(spark, sf_dir):
    o = _orders(spark, sf_dir)
    order = ["o_orderdate", "o_orderkey"]
    a = win.shift(o, ["o_custkey"], order, "o_totalprice", 1, default=0.0, out="lag_price")
    b = win.shift(a, ["o_custkey"], order, "o_orderkey", -2, out="lead_key")
    return b.select("o_orderkey", "lag_price", "lead_key")


@query("w5_frame_aggregates", ids=("W5",), sql="""
SELECT o_orderkey,
       max(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING) AS max_next,
       min(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING) AS min_next,
       count(*) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING) AS cnt_next,
       max(o_totalprice) OVER (PARTITION BY o_custkey) AS max_all
FROM orders""")
def w5_frame_aggregates(spark, sf_dir):
    o = _orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_totalprice")
    g, order = ["o_custkey"], ["o_orderkey"]
    framed = win.rows_frames(o, g, order, "o_totalprice", 0, 1, {"max_next": "max", "min_next": "min", "cnt_next": "count"})
    return win.group_total(framed, g, "o_totalprice", "max", "max_all").select(
        "o_orderkey", "max_next", "min_next", "cnt_next", "max_all")


@query("w5_window_without_partition", ids=("W5",), sql="""
SELECT o_orderkey, max(o_totalprice) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_max,
       count(*) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_count
FROM orders""")
def w5_window_without_partition(spark, sf_dir):
    o = _orders(spark, sf_dir).select("o_orderkey", "o_totalprice")
    r = win.runnings(o, [], ["o_orderkey"], {"running_max": ("o_totalprice", "max"), "running_count": ("o_orderkey", "count")})
    return r.select("o_orderkey", "running_max", "running_count")


@query("w1_builtin_window_spec", ids=("W1",), sql="""
SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INTEGER) AS rn
FROM orders""")
def w1_builtin_window_spec(spark, sf_dir):
    """row_number per key: the Window spec (partitionBy/orderBy/over) runs
    per range-partition span inside ``win.row_number``, so a hot key is
    numbered across many tasks instead of one."""
    o = _orders(spark, sf_dir).select("o_custkey", "o_orderkey")
    r = win.row_number(o, ["o_custkey"], ["o_orderkey"], "rn")
    return r.select("o_custkey", "o_orderkey", F.col("rn").cast("int").alias("rn"))


_NULLY_SQL = """WITH x AS (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS grp, CAST(nullif(o_custkey % 40, 3) AS INTEGER) AS ord,
  CASE WHEN o_orderkey % 3 = 0 OR o_orderkey < 200 THEN NULL ELSE o_totalprice END AS val FROM orders)"""


def _nully(spark, sf_dir):
    """Orders with NULL groups, order values and values."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("grp"),
                    F.nullif(F.col("o_custkey") % 40, F.lit(3)).cast("int").alias("ord"),
                    F.when(~((F.col("o_orderkey") % 3 == 0) | (F.col("o_orderkey") < 200)), F.col("o_totalprice")).alias("val"))


@query("w1_running_with_nulls", ids=("W1", "W2"), sql=_NULLY_SQL + """
SELECT o_orderkey, round(sum(val) OVER w, 2) AS total, count(val) OVER w AS n, min(val) OVER w AS least, max(val) OVER w AS most FROM x
WINDOW w AS (PARTITION BY grp ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def w1_running_with_nulls(spark, sf_dir):
    r = win.runnings(_nully(spark, sf_dir), ["grp"], ["o_orderkey"], {"total": ("val", "sum"), "n": ("val", "count"),
                                                                        "least": ("val", "min"), "most": ("val", "max")})
    return r.select("o_orderkey", F.round("total", 2).alias("total"), "n", "least", "most")


@query("w2_range_frame_with_nulls", ids=("W2",), sql=_NULLY_SQL + """
SELECT o_orderkey, round(sum(val) OVER w, 2) AS total, count(*) OVER (PARTITION BY grp) AS in_group FROM x
WINDOW w AS (PARTITION BY grp ORDER BY ord NULLS FIRST RANGE BETWEEN 5 PRECEDING AND 2 FOLLOWING)""")
def w2_range_frame_with_nulls(spark, sf_dir):
    x = win.range_frame(_nully(spark, sf_dir), ["grp"], "ord", "val", -5, 2, "sum", "total")
    return win.group_total(x, ["grp"], "o_orderkey", "count", "in_group").select("o_orderkey", F.round("total", 2).alias("total"), "in_group")


@query("w3_ranks_with_nulls", ids=("W3",), sql=_NULLY_SQL + """
SELECT o_orderkey, rank() OVER w AS rank, dense_rank() OVER w AS dense_rank, round(percent_rank() OVER w, 8) AS percent_rank,
       round(cume_dist() OVER w, 8) AS cume_dist, CAST(ntile(7) OVER u AS INTEGER) AS ntile FROM x
WINDOW w AS (PARTITION BY grp ORDER BY ord NULLS FIRST), u AS (PARTITION BY grp ORDER BY ord NULLS FIRST, o_orderkey)""")
def w3_ranks_with_nulls(spark, sf_dir):
    r = win.ranks(_nully(spark, sf_dir), ["grp"], ["ord"], ["o_orderkey"], ntile=7)
    return r.select("o_orderkey", "rank", "dense_rank", F.round("percent_rank", 8).alias("percent_rank"),
                    F.round("cume_dist", 8).alias("cume_dist"), "ntile")


@query("w4_shifts_with_nulls", ids=("W4",), sql=_NULLY_SQL + """
SELECT o_orderkey, lag(val, 1, -1.0) OVER w AS before, lead(val, 2, -2.0) OVER w AS after FROM x
WINDOW w AS (PARTITION BY grp ORDER BY ord NULLS FIRST, o_orderkey)""")
def w4_shifts_with_nulls(spark, sf_dir):
    a = win.shift(_nully(spark, sf_dir), ["grp"], ["ord", "o_orderkey"], "val", 1, default=-1.0, out="before")
    return win.shift(a, ["grp"], ["ord", "o_orderkey"], "val", -2, default=-2.0, out="after").select("o_orderkey", "before", "after")
