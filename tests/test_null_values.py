"""NULL keys, NULL values and empty sets in operators that join or rank."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from kiln.operators import relational, stats
from kiln.operators.joins import full_join_on
from kiln.streaming import runner


def test_full_join_matches_null_keys(spark):
    a = spark.createDataFrame([(1, None, "a"), (None, None, "b"), (2, 2, "c")], "k int, m int, x string")
    b = spark.createDataFrame([(1, None, "p"), (None, None, "q"), (3, None, "r")], "k int, m int, y string")
    got = {(r.k, r.m): (r.x, r.y) for r in full_join_on(a, b, ["k", "m"]).collect()}
    assert got == {(1, None): ("a", "p"), (None, None): ("b", "q"), (2, 2): ("c", None), (3, None): (None, "r")}


def test_cogroup_of_null_keys_and_any_aggregate(spark):
    a = spark.createDataFrame([(None, 1.0), (None, 2.0), (1, 5.0)], "k int, v double")
    b = spark.createDataFrame([(None, 7.0), (2, None)], "k int, v double")
    rows = relational.cogroup_aggregate(a, b, "k", "v", ("na", "sa"), ("nb", "sb")).collect()
    assert {r.k: (r.na, r.sa, r.nb, r.sb) for r in rows} == {None: (2, 3.0, 1, 7.0), 1: (1, 5.0, 0, None), 2: (0, None, 1, None)}
    assert len(rows) == 3
    c = spark.createDataFrame([(None, "x"), (1, "y"), (1, "z")], "k int, s string")
    got = relational.cogroup([(a, {"total": F.sum("v")}), (b, {"any": F.max(F.struct("v"))}),
                              (c, {"both": F.sort_array(F.collect_set("s")), "counts": F.max(F.map_from_arrays(F.array("s"), F.array(F.lit(1)))["x"])})], ["k"])
    assert {r.k: (r.total, r.any and r.any.v, r.both, r.counts) for r in got.collect()} == \
        {None: (3.0, 7.0, ["x"], 1), 1: (5.0, None, ["y", "z"], None), 2: (None, None, None, None)}
    with pytest.raises(ValueError):
        relational.cogroup([(a, {"n": F.sum("v")}), (b, {"n": F.sum("v")})], ["k"])


def test_keyed_state_of_the_null_key(spark):
    df = spark.createDataFrame([(i, None if i % 2 else 1) for i in range(12)], "id bigint, k int")
    s = runner.stage(df, "null-state", 3, "id").stream(spark)
    out = runner.update_state_by_key(s, "null-state", "k", {"fresh": F.count(F.lit(1))},
                                     {"n": F.coalesce("n", F.lit(0)) + F.coalesce("fresh", F.lit(0))}, F.lit(True), "k int, n bigint")
    assert sorted(((r.k, r.n) for r in out.collect()), key=str) == [(1, 6), (None, 6)]


def test_spearman_of_complete_rows(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0), (3, 2.0), (4, None)], "x int, y double")
    got = {(r.i, r.j): r["corr"] for r in stats.correlation_matrix(df, ["x", "y"], "spearman").collect()}
    assert got == pytest.approx({("x", "x"): 1.0, ("x", "y"): 0.5, ("y", "x"): 0.5, ("y", "y"): 1.0})
    with_null_id = df.withColumn("id", F.when(F.col("x") > 1, F.col("x")))
    assert stats.correlation_matrix(with_null_id.fillna(9.0), ["x", "y"], "spearman", id_col="id").count() == 4


def test_chi_square_of_complete_rows(spark):
    rows = [("a", "p"), ("a", "q"), ("a", "q"), ("b", "p"), ("b", "q"), (None, "p"), ("a", None)]
    r = stats.chi_square_independence(spark.createDataFrame(rows, "x string, y string"), "x", "y").first()
    assert r.statistic == pytest.approx(0.1389, abs=1e-4) and r.dof == 1
    none = stats.chi_square_independence(spark.createDataFrame(rows[-2:], "x string, y string"), "x", "y").first()
    assert (none.statistic, none.dof, none.p_value) == (0.0, 0, 1.0)


def test_multilabel_of_empty_sets(spark):
    df = spark.createDataFrame([([], []), (["a"], ["a"]), ([], ["b"]), (None, [])], "p array<string>, l array<string>")
    r = stats.multilabel_metrics(df, "p", "l", 2).first()
    assert (r.subset_accuracy, r.accuracy, r.f1) == (0.75, 0.75, 0.75)
    assert (r.precision, r.recall, r.micro_precision, r.micro_recall) == (0.25, 0.25, 1.0, 0.5)
    empty = stats.multilabel_metrics(df.where("size(l) = 0"), "p", "l", 2).first()
    assert (empty.accuracy, empty.f1, empty.micro_precision, empty.micro_f1, empty.hamming_loss) == (1.0, 1.0, 1.0, 1.0, 0.0)


def test_ranking_of_a_null_query(spark):
    ranked = spark.createDataFrame([(None, 5, 0), (None, 6, 1), (1, 5, 0)], "q int, item int, pos int")
    relevant = spark.createDataFrame([(None, 5), (1, 7)], "q int, item int")
    r = stats.ranking_metrics(ranked, relevant, "q", "item", "pos", 1).first()
    assert (r.precision_at_k, r.mean_avg_precision, r.n_queries) == (0.5, 0.5, 2)
