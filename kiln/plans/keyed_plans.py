"""Queries of the operators that take functions of the user's own: keyed and
tree aggregation, partitioning, keyed streaming state, sliding windows with an
inverse; and of top-n products, gradient descent and the KS test."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F

from kiln.functions import random_columns as rnd
from kiln.operators import partitioning, relational, sgd, stats, top_products
from kiln.operators import user_aggregates as user
from kiln.plans.registry import query
from kiln.plans.stream_plans import _CHUNK_SQL, N_BATCHES, _event_stream, _fmt, _staged, _ts, _windows_sql
from kiln.sources.tables import table
from kiln.streaming import keyed, runner


# ------------------------------------------------------------ A14, A16: user functions

def _largest_three(acc, value):
    """(rows, total, the three largest values, descending)."""
    n, total, top = acc
    return n + 1, total + value[0], sorted([*top, value[0]], reverse=True)[:3]


def _merge_three(a, b):
    return a[0] + b[0], a[1] + b[1], sorted([*a[2], *b[2]], reverse=True)[:3]


@query("a14_aggregate_by_key_struct", ids=("A14",), sql="""
SELECT l_suppkey, count(*) AS n, round(sum(l_extendedprice), 2) AS total,
       array_to_string(list_transform(list_sort(list(l_extendedprice), 'DESC')[1:3], lambda v: CAST(round(v * 100) AS BIGINT)), ',') AS largest
FROM lineitem GROUP BY 1""")
def a14_aggregate_by_key_struct(spark, sf_dir):
    """``aggregateByKey`` with an accumulator of a count, a sum and an array."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_extendedprice")
    out = user.aggregate_by_key(li, ["l_suppkey"], ["l_extendedprice"], (0, 0.0, []), _largest_three, _merge_three,
                                "n bigint, total double, largest array<double>")
    cents = F.transform("largest", lambda v: F.round(v * 100).cast("bigint").cast("string"))
    return out.select("l_suppkey", "n", F.round("total", 2).alias("total"), F.array_join(cents, ",").alias("largest"))


@query("a14_fold_by_key_user_function", ids=("A14",), sql="""
SELECT o_custkey, max(o_totalprice) AS o_totalprice, min(o_orderkey) FILTER (WHERE o_totalprice = top) AS o_orderkey
FROM (SELECT *, max(o_totalprice) OVER (PARTITION BY o_custkey) AS top FROM orders) GROUP BY 1""")
def a14_fold_by_key_user_function(spark, sf_dir):
    """``foldByKey`` to each customer's dearest order (the first by key of equal ones)."""
    o = table(spark, sf_dir, "orders")
    return user.fold_by_key(o, ["o_custkey"], ["o_totalprice", "o_orderkey"], (-math.inf, 0), lambda a, b: min(a, b, key=lambda v: (-v[0], v[1])))


def _moments(acc, value):
    n, mean, m2 = acc
    if value[0] is None:
        return acc
    n, d = n + 1, value[0] - mean
    mean += d / n
    return n, mean, m2 + d * (value[0] - mean)


def _merge_moments(a, b):
    if not a[0] or not b[0]:
        return a if a[0] else b
    n, d = a[0] + b[0], b[1] - a[1]
    return n, a[1] + d * b[0] / n, a[2] + b[2] + d * d * a[0] * b[0] / n


@query("a16_tree_aggregate_user_functions", ids=("A16",), sql="""
SELECT count(l_extendedprice) AS n, round(avg(l_extendedprice), 4) AS mean, round(stddev_pop(l_extendedprice), 4) AS deviation FROM lineitem""")
def a16_tree_aggregate_user_functions(spark, sf_dir):
    """``treeAggregate`` of depth 3 with a mergeable moment accumulator."""
    t = user.tree_aggregate(table(spark, sf_dir, "lineitem"), ["l_extendedprice"], (0, 0.0, 0.0), _moments, _merge_moments,
                            "n bigint, mean double, m2 double", depth=3)
    return t.select("n", F.round("mean", 4).alias("mean"), F.round(F.sqrt(F.col("m2") / F.col("n")), 4).alias("deviation"))


@query("a16_tree_reduce_user_function", ids=("A16",), sql="""
SELECT l_linestatus, l_orderkey, l_linenumber FROM lineitem ORDER BY l_linestatus DESC, l_orderkey DESC, l_linenumber DESC LIMIT 1""")
def a16_tree_reduce_user_function(spark, sf_dir):
    return user.tree_reduce(table(spark, sf_dir, "lineitem"), ["l_linestatus", "l_orderkey", "l_linenumber"], max)


# ------------------------------------------------------------ D16, O4: partition function

def _by_first_digit(keys: pd.Series) -> pd.Series:
    return keys.str[0].astype(int) * 7


@query("d16_custom_partition_function", ids=("D16",), sql="""
SELECT o_orderpriority, CAST(CAST(left(o_orderpriority, 1) AS INTEGER) * 7 % 4 AS INTEGER) AS partition, count(*) AS n FROM orders GROUP BY 1, 2""")
def d16_custom_partition_function(spark, sf_dir):
    o = partitioning.partition_by(table(spark, sf_dir, "orders").select("o_orderpriority"), 4, "o_orderpriority", _by_first_digit)
    return o.groupBy("o_orderpriority", F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("n"))


@query("o4_partition_and_sort_by_functions", ids=("O4", "D16"), sql="""
SELECT CAST(o_custkey // 10 % 5 AS INTEGER) AS partition, o_orderkey,
       row_number() OVER (PARTITION BY o_custkey // 10 % 5 ORDER BY o_custkey % 10 DESC, o_orderkey) - 1 AS pos FROM orders""")
def o4_partition_and_sort_by_functions(spark, sf_dir):
    """Partition function, key function and direction; a row's place is read
    from the partition itself."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    placed = partitioning.repartition_and_sort(o, 5, F.floor(F.col("o_custkey") / 10), None, [F.pmod("o_custkey", F.lit(10)), "o_orderkey"], [False, True])
    at = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)
    return placed.select(F.spark_partition_id().alias("partition"), "o_orderkey", at.alias("pos"))


# ------------------------------------------------------------ J7: cogroup

@query("j7_cogroup_three_inputs", ids=("J7",), sql="""
WITH a AS (SELECT CASE WHEN o_custkey % 5 > 0 THEN o_custkey % 50 END AS k, count(*) AS n_orders, max(o_orderdate)::VARCHAR AS last_order FROM orders GROUP BY 1),
b AS (SELECT CASE WHEN c_nationkey % 3 > 0 THEN c_nationkey END AS k, min(c_acctbal) AS least_balance FROM customer GROUP BY 1),
c AS (SELECT CASE WHEN s_suppkey % 2 > 0 THEN s_suppkey % 60 END AS k, count(DISTINCT s_nationkey) AS n_nations FROM supplier GROUP BY 1),
k AS (SELECT k FROM a UNION SELECT k FROM b UNION SELECT k FROM c)
SELECT k.k, n_orders, last_order, least_balance, n_nations FROM k
LEFT JOIN a ON a.k IS NOT DISTINCT FROM k.k LEFT JOIN b ON b.k IS NOT DISTINCT FROM k.k LEFT JOIN c ON c.k IS NOT DISTINCT FROM k.k""")
def j7_cogroup_three_inputs(spark, sf_dir):
    """Three inputs and their own aggregates, the NULL key in each."""
    def key(name: str, spared: int, wrap: int | None) -> F.Column:
        c = F.col(name)
        return F.when(c % spared > 0, c % wrap if wrap else c).cast("bigint").alias("k")

    o = table(spark, sf_dir, "orders").select(key("o_custkey", 5, 50), "o_orderdate")
    c = table(spark, sf_dir, "customer").select(key("c_nationkey", 3, None), "c_acctbal")
    s = table(spark, sf_dir, "supplier").select(key("s_suppkey", 2, 60), "s_nationkey")
    return relational.cogroup([(o, {"n_orders": F.count(F.lit(1)), "last_order": F.max("o_orderdate").cast("string")}),
                               (c, {"least_balance": F.min("c_acctbal")}), (s, {"n_nations": F.count_distinct("s_nationkey")})], ["k"])


# ------------------------------------------------------------ T7, T8: windows with an inverse

HOURS = 48


def _sliding(spark, sf_dir, name, keys, keep=None):
    """Counts and cents of 48 hours, every hour."""
    with runner.utc_session(spark):
        end = table(spark, sf_dir, "events").agg(F.max("ts").cast("timestamp")).first()[0]
        s = _ts(_staged(spark, sf_dir, name, (HOURS + 24) * 3600).stream(spark))
        one = F.when(F.col("ts") <= F.lit(end), 1).otherwise(0).cast("bigint")         # the closing row counts nothing
        cents = F.when(F.col("ts") <= F.lit(end), F.round(F.coalesce("value", F.lit(0.0)) * 10_000).cast("bigint")).otherwise(0).cast("bigint")
        out = keyed.reduce_by_key_and_window(
            s.withColumn("n", one).withColumn("units", cents), name, keys, "ts", ["n", "units"], 3600, HOURS,
            lambda a, b: (a[0] + b[0], a[1] + b[1]), lambda a, b: (a[0] - b[0], a[1] - b[1]), keep or (lambda v: v[0] > 0), delay="12 hours")
        return out.select(*keys, F.date_format(F.timestamp_millis("window_start_ms").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n", "units")


_UNITS = "sum(CAST(round(coalesce(value, 0) * 10000) AS BIGINT))::BIGINT"


@query("t7_reduce_by_window_with_inverse", ids=("T7",), sql=_windows_sql(HOURS * 3600, 3600) + f"""
SELECT window_start, count(*) AS n, {_UNITS} AS units FROM win GROUP BY 1""")
def t7_reduce_by_window_with_inverse(spark, sf_dir):
    return _sliding(spark, sf_dir, "t7i", [])


@query("t8_reduce_by_key_and_window_with_inverse", ids=("T8",), sql=_windows_sql(HOURS * 3600, 3600) + f"""
SELECT window_start, event_type, count(*) AS n, {_UNITS} AS units FROM win GROUP BY 1, 2 HAVING count(*) > 2""")
def t8_reduce_by_key_and_window_with_inverse(spark, sf_dir):
    """Windows 48 slides long; ``filterFunc`` keeps those of more than two rows."""
    return _sliding(spark, sf_dir, "t8i", ["event_type"], lambda v: v[0] > 2)


@query("t8_group_by_key_and_window", ids=("T8",), sql=_windows_sql(86400, 43200) + """
SELECT window_start, event_type, event_id, row_number() OVER (PARTITION BY window_start, event_type ORDER BY ts, event_id) - 1 AS pos FROM win""")
def t8_group_by_key_and_window(spark, sf_dir):
    with runner.utc_session(spark):
        s = _ts(_event_stream(spark, sf_dir, "t8g")).select("event_id", "event_type", "ts")
        out = keyed.group_by_key_and_window(s, "t8g", ["event_type"], "ts", "1 day", "12 hours", ["ts", "event_id"])
        return out.select(_fmt("window_start").alias("window_start"), "event_type", "event_id", "pos")


# ------------------------------------------------------------ T10: state by a user function

def _last_three(new: list[tuple], old: tuple | None) -> tuple | None:
    """The last three event ids of a user, and batches without any since;
    after two such batches in a row the user is removed."""
    ids, idle = old or ([], 0)
    if not new:
        return None if idle == 1 else (ids, idle + 1)
    return sorted([*ids, *(v[0] for v in new)])[-3:], 0


@query("t10_update_state_user_function", ids=("T10",), sql=f"""
WITH e AS (SELECT CASE WHEN user_id % 7 > 0 THEN user_id END AS u, event_id, {_CHUNK_SQL} AS chunk FROM events),
g AS (SELECT u.u, k.chunk, (SELECT count(*) FROM e WHERE e.u IS NOT DISTINCT FROM u.u AND e.chunk = k.chunk) AS n
      FROM (SELECT DISTINCT u FROM e) u CROSS JOIN (SELECT unnest(range({N_BATCHES})) AS chunk) k),
r AS (SELECT u, chunk, n, lag(n) OVER (PARTITION BY u ORDER BY chunk) AS before FROM g),
m AS (SELECT u, coalesce(max(chunk) FILTER (WHERE n = 0 AND before = 0), -1) AS removed,
             max(chunk) FILTER (WHERE n > 0) AS last FROM r GROUP BY 1)
SELECT m.u AS user_id, array_to_string(list_reverse(list_sort(list(e.event_id), 'DESC')[1:3]), ',') AS last_ids,
       CAST({N_BATCHES} - 1 - max(m.last) AS INTEGER) AS idle
FROM m JOIN e ON e.u IS NOT DISTINCT FROM m.u AND e.chunk > m.removed GROUP BY m.u""")
def t10_update_state_user_function(spark, sf_dir):
    """Not an aggregate: the last three of a list, and a count of idle batches
    that only a call without rows can raise.  NULL is a key."""
    s = _event_stream(spark, sf_dir, "t10u").select(F.when(F.col("user_id") % 7 > 0, F.col("user_id")).alias("user_id"), "event_id")
    changes = keyed.update_state_by_key(s, "t10u", "user_id", ["event_id"], "ids array<bigint>, idle int", _last_three,
                                        shrink=lambda values: sorted(values)[-3:])
    return keyed.latest_state(changes, "user_id").select("user_id", F.array_join(F.col("ids").cast("array<string>"), ",").alias("last_ids"), "idle")


# ------------------------------------------------------------ M9, M17: top n by inner product

@query("m17_top_products_for_given_queries", ids=("M17", "M9"), sql="""
WITH p AS (SELECT q.vec_id AS query_id, i.vec_id AS item_id,
                  list_inner_product(q.embedding::DOUBLE[], i.embedding::DOUBLE[]) AS score
           FROM embeddings q, embeddings i WHERE q.vec_id % 50 = 0 AND q.vec_id <> i.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM p)
SELECT query_id, item_id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM r WHERE rank <= 5""")
def m17_top_products_for_given_queries(spark, sf_dir):
    """Recommending n for given users, or synonyms of given words: their
    vectors against all items'."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    given = e.where(F.col("vec_id") % 50 == 0).withColumnRenamed("vec_id", "query_id")
    items = e.withColumnRenamed("vec_id", "item_id")
    out = top_products.top_inner_products(given, items, 5, "query_id", "embedding", "item_id", "embedding", exclude_same_id=True)
    return out.withColumn("score", F.round("score", 6))


# ------------------------------------------------------------ M11, M12: gradient descent

_TRUTH = (2.0, -3.0, 0.0, 0.0)


def _planted(spark, sf_dir):
    """y of two of four inputs, drawn from the order key, over the orders."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    x = rnd.uniform_vector(4, 11, "id")
    x = F.transform(x, lambda v: 2 * v - 1)
    dot = sum((F.get("x", F.lit(i)) * w for i, w in enumerate(_TRUTH)), F.lit(0.5))
    return o.select("id", x.alias("x")).withColumn("y", dot)


@query("m12_lasso_and_ridge_with_sgd", ids=("M12",), sql="""
SELECT unnest(['least squares', 'lasso', 'ridge']) AS model, unnest([2.0, NULL, NULL]) AS first, unnest([-3.0, NULL, NULL]) AS second,
       unnest([0.5, NULL, NULL]) AS intercept, unnest([false, true, false]) AS zeros, unnest([false, true, true]) AS shrunk""")
def m12_lasso_and_ridge_with_sgd(spark, sf_dir):
    """On a planted function: least squares finds its weights, lasso sets the
    two idle ones to exactly 0, lasso and ridge shrink the others."""
    rows, data = [], _planted(spark, sf_dir).persist()
    for name, updater, reg, steps in (("least squares", "none", 0.0, 80), ("lasso", "l1", 0.1, 40), ("ridge", "l2", 0.1, 40)):
        m = sgd.fit_sgd(data, "x", "y", "squared", updater, reg, 3.0, steps, intercept=True)
        w = m.weights
        exact = updater == "none"
        rows.append((name, *(float(round(v, 2)) + 0.0 if exact else None for v in (w[0], w[1], m.intercept)), bool(w[2] == 0 and w[3] == 0),
                     bool(abs(w[0]) < 1.95 and abs(w[1]) < 2.95)))
    data.unpersist()
    return spark.createDataFrame(rows, "model string, first double, second double, intercept double, zeros boolean, shrunk boolean")


@query("m11_mini_batch_classifiers", ids=("M11",), sql="""
SELECT unnest(['logistic', 'hinge']) AS loss, true AS accurate, true AS in_order, true AS from_initial""")
def m11_mini_batch_classifiers(spark, sf_dir):
    """Classes by the sign of a planted function, from a tenth of the rows a
    step: few are wrong, the weights lean as the truth does, and starting at
    the truth beats starting at 0 after one step."""
    data = _planted(spark, sf_dir).withColumn("label", (F.col("y") > 0).cast("double")).persist()
    rows = []
    for loss in ("logistic", "hinge"):
        m = sgd.fit_sgd(data, "x", "label", loss, "l2", 0.001, 5.0, 30, fraction=0.1, intercept=True)
        right = data.agg(F.avg(((m.margin("x") > 0) == (F.col("label") == 1)).cast("double"))).first()[0]
        cold, warm = (sgd.fit_sgd(data, "x", "label", loss, iterations=1, initial=w, intercept=True).losses[0] for w in (None, [*_TRUTH, 0.5]))
        rows.append((loss, bool(right > 0.95), bool(m.weights[0] > 0 > m.weights[1] and max(abs(m.weights[2:])) < 0.2 * abs(m.weights[0])), bool(warm < cold)))
    data.unpersist()
    return spark.createDataFrame(rows, "loss string, accurate boolean, in_order boolean, from_initial boolean")


# ------------------------------------------------------------ M1, M30: own estimators

@query("m1_own_estimators_saved_and_loaded", ids=("M1", "M30"), sql="""
SELECT count(*) AS n, true AS standardised, true AS explains, true AS same_after_loading FROM orders""")
def m1_own_estimators_saved_and_loaded(spark, sf_dir):
    """Population scaler and network in a pipeline, fitted to a planted wave,
    saved and loaded: nine tenths of the variance are explained, and the
    loaded pipeline predicts the same."""
    from pyspark.ml import Pipeline, PipelineModel

    from kiln.operators.estimators import MlpRegressor, PopulationScaler
    from kiln.session import scratch_path
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    x = rnd.uniform_vector(2, 21, "id")
    data = o.select("id", (2 * x[0] - 1).alias("a"), x[1].alias("b")).withColumn("y", 5 + 2 * F.sin(3 * F.col("a")) + F.col("b"))
    fitted = Pipeline(stages=[PopulationScaler(inputCols=["a", "b"], outputCols=["za", "zb"]),
                              MlpRegressor(inputCols=["za", "zb"], labelCol="y", hidden=[6], maxIter=30, seed=2)]).fit(data)
    path = scratch_path(spark, "pipeline")
    fitted.save(path)
    again = PipelineModel.load(path).transform(data).select("id", F.col("prediction").alias("loaded"))
    both = fitted.transform(data).join(again, "id")
    return both.agg(F.count(F.lit(1)).alias("n"), ((F.abs(F.avg("za")) < 1e-9) & (F.abs(F.stddev_pop("zb") - 1) < 1e-9)).alias("standardised"),
                    (F.avg(F.pow(F.col("prediction") - F.col("y"), 2)) < 0.1 * F.var_pop("y")).alias("explains"),
                    F.every(F.col("prediction") == F.col("loaded")).alias("same_after_loading"))


# ------------------------------------------------------------ M21: Kolmogorov-Smirnov

@query("m21_kolmogorov_smirnov", ids=("M21",), sql="""
WITH v AS (SELECT CASE WHEN l_linenumber < 7 THEN l_quantity END AS x FROM lineitem),
c AS (SELECT x, count(*) AS c FROM v WHERE x IS NOT NULL GROUP BY x),
s AS (SELECT x, c, sum(c) OVER (ORDER BY x) AS upto, sum(c) OVER () AS n FROM c),
d AS (SELECT n, x, greatest(upto / n - (x - 0.5) / 50.0, (x - 0.5) / 50.0 - (upto - c) / n) AS d FROM s)
SELECT CAST(max(n) AS BIGINT) AS n, round(max(d), 9) AS statistic FROM d""")
def m21_kolmogorov_smirnov(spark, sf_dir):
    """Quantities, many of them tied and some NULL, against the uniform
    distribution from 0.5 to 50.5."""
    li = table(spark, sf_dir, "lineitem").select(F.when(F.col("l_linenumber") < 7, F.col("l_quantity")).alias("x"))
    return stats.kolmogorov_smirnov(li, "x", lambda x: (x - 0.5) / 50.0).select("n", F.round("statistic", 9).alias("statistic"))


# ------------------------------------------------------------ M20, M21, M27: NULL and empty values

@query("m20_spearman_with_nulls", ids=("M20",), sql="""
WITH b AS (SELECT CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice END AS x, CASE WHEN o_orderkey % 4 > 0 THEN o_custkey END AS y FROM orders),
c AS (SELECT * FROM b WHERE x IS NOT NULL AND y IS NOT NULL),
r AS (SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
             rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM c),
v AS (SELECT round(corr(rx, ry), 8) AS corr FROM r)
SELECT unnest(['x', 'x', 'y', 'y']) AS i, unnest(['x', 'y', 'x', 'y']) AS j, unnest([1.0, (SELECT corr FROM v), (SELECT corr FROM v), 1.0]) AS corr""")
def m20_spearman_with_nulls(spark, sf_dir):
    """Each pair over the rows that have both values."""
    o = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 3 > 0, F.col("o_totalprice")).alias("x"),
                                              F.when(F.col("o_orderkey") % 4 > 0, F.col("o_custkey")).alias("y"))
    return stats.correlation_matrix(o, ["x", "y"], "spearman").withColumn("corr", F.round("corr", 8))


@query("m21_chi_square_with_nulls", ids=("M21",), sql="""
WITH b AS (SELECT CASE WHEN l_orderkey % 5 > 0 THEN l_returnflag END AS x, CASE WHEN l_orderkey % 7 > 0 THEN l_linenumber END AS y FROM lineitem),
c AS (SELECT * FROM b WHERE x IS NOT NULL AND y IS NOT NULL),
cells AS (SELECT x, y, count(*) AS o FROM c GROUP BY 1, 2), rx AS (SELECT x, count(*) AS rx FROM c GROUP BY 1),
ry AS (SELECT y, count(*) AS ry FROM c GROUP BY 1), n AS (SELECT count(*) AS n FROM c),
grid AS (SELECT rx.x, ry.y, rx.rx * ry.ry / n.n AS e FROM rx, ry, n)
SELECT round(sum(power(coalesce(c.o, 0) - g.e, 2) / g.e), 6) AS statistic,
       CAST(((SELECT count(*) FROM rx) - 1) * ((SELECT count(*) FROM ry) - 1) AS INTEGER) AS dof
FROM grid g LEFT JOIN cells c USING (x, y)""")
def m21_chi_square_with_nulls(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.when(F.col("l_orderkey") % 5 > 0, F.col("l_returnflag")).alias("x"),
                                                 F.when(F.col("l_orderkey") % 7 > 0, F.col("l_linenumber")).alias("y"))
    return stats.chi_square_independence(li, "x", "y").select(F.round("statistic", 6).alias("statistic"), "dof")


@query("m27_multilabel_with_empty_sets", ids=("M27",), sql="""
WITH x AS (SELECT list_filter([CASE WHEN quality = 1 THEN 'q' END, CASE WHEN toxic = 1 THEN 't' END], lambda v: v IS NOT NULL) AS l,
                  list_filter([CASE WHEN n_chars > 5000 THEN 'q' END, CASE WHEN contains(text, '!') THEN 't' END], lambda v: v IS NOT NULL) AS p
           FROM labels JOIN documents USING (doc_id)),
y AS (SELECT len(list_intersect(p, l)) AS i, len(list_distinct(list_concat(p, l))) AS u, len(p) AS np, len(l) AS nl, list_sort(p) = list_sort(l) AS eq FROM x)
SELECT round(avg(CAST(eq AS DOUBLE)), 8) AS subset_accuracy, round(avg(CASE WHEN u = 0 THEN 1 ELSE i / u END), 8) AS accuracy,
       round(avg(CASE WHEN np > 0 THEN i / np ELSE 0 END), 8) AS precision, round(avg(CASE WHEN nl > 0 THEN i / nl ELSE 0 END), 8) AS recall,
       round(avg(CASE WHEN u = 0 THEN 1 ELSE 2 * i / (np + nl) END), 8) AS f1, round(sum(i) / sum(np), 8) AS micro_precision FROM y""")
def m27_multilabel_with_empty_sets(spark, sf_dir):
    both = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id")
    sets = both.select(F.array_compact(F.array(F.when(F.col("quality") == 1, "q"), F.when(F.col("toxic") == 1, "t"))).alias("l"),
                       F.array_compact(F.array(F.when(F.col("n_chars") > 5000, "q"), F.when(F.col("text").contains("!"), "t"))).alias("p"))
    m = stats.multilabel_metrics(sets, "p", "l", 2)
    return m.select(*(F.round(c, 8).alias(c) for c in ("subset_accuracy", "accuracy", "precision", "recall", "f1", "micro_precision")))


# ------------------------------------------------------------ S12: random vectors

@query("s12_random_vectors", ids=("S12",), sql="""
SELECT unnest(['uniform', 'normal', 'log_normal', 'exponential', 'poisson', 'gamma']) AS name, 3 * (SELECT count(*) FROM orders) AS n,
       true AS mean_in_bounds, true AS spread_in_bounds, true AS independent""")
def s12_random_vectors(spark, sf_dir):
    """Three elements of each distribution per order: mean, deviation, and no
    correlation between the elements."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    drawn = {"uniform": (rnd.uniform_vector(3, 1, "id"), 0.5, 12 ** -0.5), "normal": (rnd.normal_vector(3, 2, "id"), 0.0, 1.0),
             "log_normal": (rnd.log_normal_vector(0.0, 0.5, 3, 3, "id"), 1.1331, 0.6039), "exponential": (rnd.exponential_vector(2.0, 3, 4, "id"), 2.0, 2.0),
             "poisson": (rnd.poisson_vector(3.0, 3, 5, "id"), 3.0, 3 ** 0.5), "gamma": (rnd.gamma_vector(2.0, 1.5, 3, 6, "id"), 3.0, 1.5 * 2 ** 0.5)}
    wide = o.select(*(v.alias(c) for c, (v, _, _) in drawn.items()))
    rows = wide.select(F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).alias("x"), F.lit(m).alias("m"), F.lit(s).alias("s"))
                                           for c, (_, m, s) in drawn.items()))).alias("r")).select("r.*")
    n, m, s = 3 * F.count("x"), F.first("m"), F.first("s")
    total = F.sum(F.aggregate("x", F.lit(0.0), lambda a, v: a + v))
    square = F.sum(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v))
    bound = 6 / F.sqrt(F.count("x"))
    alone = [F.abs(F.corr(F.get("x", F.lit(i)), F.get("x", F.lit(j)))) < bound for i, j in ((0, 1), (0, 2), (1, 2))]
    return rows.groupBy("name").agg(n.alias("n"), (F.abs(total / n - m) < 6 * s / F.sqrt(n)).alias("mean_in_bounds"),
                                    F.sqrt(square / n - F.pow(total / n, 2)).between(s * 0.75, s * 1.3).alias("spread_in_bounds"),
                                    (alone[0] & alone[1] & alone[2]).alias("independent"))
