"""Aggregation, partitioning, descent and top-n under functions of the user's
own: against plain Python, with hot and NULL keys and empty tables."""

from __future__ import annotations

import contextlib
import io
import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from kiln.operators import partitioning, sgd, stats, top_products
from kiln.operators import user_aggregates as user


def _tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue().split("\n\n")[0]


def test_mutable_zero_is_copied_for_every_key(spark):
    def append(acc, value):                                 # changes the zero value's copy in place
        acc[0].append(value[0])
        acc[0].sort()
        del acc[0][3:]
        return acc

    def join(a, b):
        return [sorted([*a[0], *b[0]])[:3]]

    rng = random.Random(1)
    rows = [(rng.choice([None, 1, 2, 3]), rng.randint(0, 1000)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(7)
    zero = ([],)
    for depth in (1, 2, 4):
        got = {r.k: r.least for r in user.aggregate_by_key(df, ["k"], ["v"], zero, append, join, "least array<int>", depth).collect()}
        assert got == {k: sorted(v for q, v in rows if q == k)[:3] for k in (None, 1, 2, 3)}
    assert zero == ([],)


def test_fold_reduce_and_combine(spark):
    rows = [("a", 3), ("b", 4), ("a", 5), (None, 6), (None, 7), ("c", None)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(3)
    add = lambda a, b: (a[0] + (b[0] or 0),)
    assert {r.k: r.v for r in user.fold_by_key(df, ["k"], ["v"], (0,), add).collect()} == {"a": 8, "b": 4, None: 13, "c": 0}
    some = df.where("v is not null")
    assert {r.k: r.v for r in user.reduce_by_key(some, ["k"], ["v"], lambda a, b: (a[0] * b[0],)).collect()} == {"a": 15, "b": 4, None: 42}
    got = user.combine_by_key(df, ["k"], ["v"], lambda v: ([v[0]],), lambda a, v: ([*a[0], v[0]],), lambda a, b: ([*a[0], *b[0]],), "all array<int>")
    assert {r.k: sorted(r.all, key=str) for r in got.collect()} == {"a": [3, 5], "b": [4], None: [6, 7], "c": [None]}
    assert user.reduce_by_key(df.limit(0), ["k"], ["v"], add).count() == 0


def test_tree_forms(spark):
    df = spark.range(1000).repartition(40).select(F.col("id").alias("v"))
    add = lambda a, b: (a[0] + b[0],)
    assert [tuple(r) for r in user.tree_aggregate(df, ["v"], (0,), add, add, "total bigint", depth=3).collect()] == [(499500,)]
    assert [tuple(r) for r in user.tree_aggregate(df.limit(0), ["v"], (0,), add, add, "total bigint").collect()] == [(0,)]
    assert user.tree_reduce(df, ["v"], max).first().v == 999
    with pytest.raises(PySparkException, match="empty table"):
        user.tree_reduce(df.limit(0), ["v"], max).collect()
    with pytest.raises(ValueError):
        user.tree_reduce(df, ["v"], max, depth=0)


def test_depth_is_the_number_of_merges(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as v")
    for depth in (1, 2, 3):
        plan = _tree(user.reduce_by_key(df, ["k"], ["v"], max, depth))
        assert plan.count("Exchange") == depth and plan.count("MapInArrow") == depth + 1, plan


def test_a_hot_key_sends_one_accumulator_a_task(spark, monkeypatch):
    """90,000 of 100,000 rows have one key: a merge sees accumulators, not rows."""
    seen = spark.sparkContext.accumulator(0)

    def comb(a, b):
        seen.add(1)
        return a[0] + b[0],

    df = spark.range(0, 100_000, 1, 64).selectExpr("if(id % 10 = 0, id, -1) as k", "id as v")
    got = user.combine_by_key(df, ["k"], ["v"], lambda v: v, lambda a, v: (a[0] + v[0],), comb, "v bigint").where("k = -1").collect()
    assert got[0].v == sum(i for i in range(100_000) if i % 10)
    assert seen.value <= 2 * 64


def test_partition_function(spark):
    df = spark.createDataFrame([(k, str(k)) for k in range(-5, 40)] + [(None, "none")], "k int, s string").repartition(3)
    placed = partitioning.partition_by(df, 4, "k", lambda s: s // 3).select("k", F.spark_partition_id().alias("p"))
    assert {r.k: r.p for r in placed.collect()} == {k: (k // 3) % 4 if k is not None else 0 for k in [*range(-5, 40), None]}
    assert partitioning.partition_by(df, 6, F.col("k")).rdd.getNumPartitions() == 6
    rows = partitioning.repartition_and_sort(df, 3, "k", lambda s: s % 2, [F.length("s"), "k"], [True, False]).rdd.glom().collect()
    assert [sorted({r.k % 2 for r in p if r.k is not None}) for p in rows] == [[0], [1], []]
    for p in rows:
        keys = [(len(r.s), -(r.k if r.k is not None else -99)) for r in p]
        assert keys == sorted(keys)
    with pytest.raises(ValueError):
        partitioning.partition_by(df, 0, "k")
    with pytest.raises(ValueError):
        partitioning.repartition_and_sort(df, 2, "k", None, ["k"], [True, False])


# ------------------------------------------------------------ gradient descent

def _data(n=300, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    return x, x @ [1.5, -2.0, 0.0] + 0.3 + rng.normal(0, 0.05, n)


@pytest.mark.parametrize("loss", ["squared", "logistic", "hinge"])
@pytest.mark.parametrize("updater, reg", [("none", 0.0), ("l1", 0.05), ("l2", 0.1)])
def test_full_batch_steps_equal_a_numpy_loop(spark, loss, updater, reg):
    x, y = _data()
    if loss != "squared":
        y = (y > 0).astype(float)
    df = spark.createDataFrame([(r.tolist(), float(v)) for r, v in zip(x, y)], "x array<double>, y double").repartition(3)
    m = sgd.fit_sgd(df, "x", "y", loss, updater, reg, 0.7, 6, intercept=True, initial=[0.1, 0.2, 0.3], keep_history=True)
    a, w = np.hstack([x, np.ones((len(x), 1))]), np.array([0.1, 0.2, 0.3, 0.0])
    for i, got in enumerate(m.history, 1):
        z = a @ w
        slope = {"squared": z - y, "logistic": 1 / (1 + np.exp(-z)) - y, "hinge": np.where((2 * y - 1) * z < 1, -(2 * y - 1), 0.0)}[loss]
        rate, g = 0.7 / np.sqrt(i), a.T @ slope / len(y)
        if updater == "l2":
            w = np.append(w[:3] * (1 - rate * reg), w[3]) - rate * g
        else:
            w = w - rate * g
            if updater == "l1":
                w[:3] = np.sign(w[:3]) * np.maximum(np.abs(w[:3]) - rate * reg, 0)
        assert np.allclose(got, w, rtol=0, atol=1e-9)
    assert len(m.history) == 6 and m.losses[-1] < m.losses[0]


def test_mini_batches_repeat_and_converge(spark):
    x, y = _data(2000)
    df = spark.createDataFrame([(r.tolist(), float(v)) for r, v in zip(x, y)], "x array<double>, y double")
    one, two = (sgd.fit_sgd(df.repartition(p), "x", "y", step=0.8, iterations=15, fraction=0.2, intercept=True, seed=5) for p in (2, 5))
    assert np.allclose(one.weights, two.weights, atol=1e-9) and np.allclose(one.weights, [1.5, -2, 0], atol=0.1)
    assert not np.allclose(one.weights, sgd.fit_sgd(df, "x", "y", step=0.8, iterations=15, fraction=0.2, intercept=True, seed=6).weights, atol=1e-9)
    lasso = sgd.fit_sgd(df, "x", "y", "squared", "l1", 0.2, 0.8, 25, intercept=True)
    assert lasso.weights[2] == 0 and abs(lasso.weights[0]) > 1
    done = sgd.fit_sgd(df, "x", "y", step=0.8, iterations=200, intercept=True, tolerance=1e-3)
    assert done.converged and len(done.losses) < 200
    got = df.select(one.margin("x").alias("m")).first().m
    assert got == pytest.approx(float(x[0] @ one.weights + one.intercept))


def test_descent_refuses_what_it_cannot_do(spark):
    df = spark.createDataFrame([([1.0], None), (None, 1.0)], "x array<double>, y double")
    with pytest.raises(ValueError, match="no row"):
        sgd.fit_sgd(df, "x", "y")
    for bad in ({"loss": "cubic"}, {"updater": "l3"}, {"fraction": 0.0}):
        with pytest.raises(ValueError):
            sgd.fit_sgd(df, "x", "y", **bad)


# ------------------------------------------------------------ top n by inner product

@pytest.mark.parametrize("cosine", [False, True])
def test_top_products_equal_brute_force(spark, monkeypatch, cosine):
    monkeypatch.setattr(top_products, "BLOCK_BYTES", 600)
    rng = np.random.default_rng(4)
    q, x = rng.integers(-3, 4, (23, 6)).astype(float), rng.integers(-3, 4, (150, 6)).astype(float)     # many ties
    x[::10] *= 20
    queries = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(q)] + [(None, [1.0] * 6), (99, None)], "u long, vec array<double>")
    items = spark.createDataFrame([(f"i{k:03d}", v.tolist()) for k, v in enumerate(x)] + [(None, [9.0] * 6), ("none", None)], "item string, vec array<double>").repartition(5)
    got = {}
    for r in top_products.top_inner_products(queries, items, 4, "u", "vec", "item", "vec", cosine).collect():
        got.setdefault(r.u, {})[r["rank"]] = (r.item, r.score)
    if cosine:
        q, x = (m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300) for m in (q, x))
    for k in range(23):
        scores = q[k] @ x.T
        if not cosine:
            want = sorted(range(150), key=lambda i: (-scores[i], i))[:4]
            assert [got[k][r][0] for r in (1, 2, 3, 4)] == [f"i{i:03d}" for i in want]
        assert [got[k][r][1] for r in (1, 2, 3, 4)] == pytest.approx(sorted(scores, reverse=True)[:4])
    assert set(got) == set(range(23))
    assert top_products.top_inner_products(queries.limit(0), items, 4, "u", "vec", "item", "vec").count() == 0
    assert top_products.top_inner_products(queries, items.limit(0), 4, "u", "vec", "item", "vec").count() == 0


# ------------------------------------------------------------ Kolmogorov-Smirnov

def test_ks_statistic_ties_and_nulls(spark):
    rng = np.random.default_rng(8)
    values = [float(v) for v in np.round(rng.random(400), 2)] + [None, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    r = stats.kolmogorov_smirnov(df, "v", lambda x: x * x).first()
    x = np.sort([v for v in values if v is not None and v == v])
    d = max(max((i + 1) / 400 - v * v, v * v - i / 400) for i, v in enumerate(x))
    assert (r.n, r.statistic) == (400, pytest.approx(d))
    edge = [v for v in x if max((x <= v).mean() - v * v, v * v - (x < v).mean()) > d - 1e-12]
    assert r.location == pytest.approx(min(edge)) and r.p_value < 1e-6
    none = stats.kolmogorov_smirnov(df.limit(0), "v", lambda x: x).first()
    assert (none.n, none.statistic, none.p_value) == (0, None, 1.0)


@pytest.mark.parametrize("n, d, p", [(1, 0.95, 0.1), (5, 0.50945, 0.1), (10, 0.40925, 0.05), (20, 0.35241, 0.01), (100, 0.13403, 0.05)])
def test_ks_p_values_of_the_tables(n, d, p):
    assert stats.ks_p_value(d, n) == pytest.approx(p, abs=2e-3)


def test_ks_limit_meets_the_exact_values():
    for d in (0.05, 0.08, 0.1, 0.15):
        assert stats.ks_p_value(d, 140) == pytest.approx(stats.ks_p_value(d, 140, exact_rows=1), abs=1e-2)      # of order 1 / n
    assert stats.ks_p_value(1.0, 5) == 0 and stats.ks_p_value(0.0, 5) == 1 and math.isfinite(stats.ks_p_value(0.3, 1000))


def test_descent_over_all_rows_reads_them_once(spark):
    """The rows are computed when they are counted and packed, not in every step."""
    rng = random.Random(3)
    rows = [([rng.uniform(-1, 1), rng.uniform(-1, 1)],) for _ in range(500)]
    seen = spark.sparkContext.accumulator(0)

    def label(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf.assign(y=pdf["x"].map(lambda x: 2 * x[0] - x[1] + 0.5))

    data = spark.createDataFrame(rows, "x array<double>").mapInPandas(label, "x array<double>, y double")
    model = sgd.fit_sgd(data, "x", "y", step=3.0, iterations=40, intercept=True)
    assert np.allclose([*model.weights, model.intercept], [2, -1, 0.5], atol=0.02) and len(model.losses) == 40
    assert seen.value <= 3 * len(rows)
