"""Skew-safe window operators equal the plain Window results, on data where
one key holds a third of the rows; and the hot key really is split."""

from __future__ import annotations

import re

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kiln.operators import windows as win
from kiln.operators.indexing import index_within_groups


@pytest.fixture(scope="module")
def skewed(spark):
    n = 3000
    rows = [(0 if i % 3 == 0 else 1 + i % 97, i, float((i * 37) % 101), (i * 7) % 50) for i in range(n)]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["k", "id", "v", "day"])).repartition(6)


def _pdf(df, cols):
    return df.select(*cols).toPandas().sort_values(cols[:2]).reset_index(drop=True)


def test_hot_key_spread_over_partitions(spark, skewed):
    tagged = skewed.repartitionByRange(8, "k", "id").where("k = 0")
    parts = tagged.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(parts) >= 3          # the hot key is not in one task


def test_running_sum_matches_window(spark, skewed):
    w = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = _pdf(skewed.withColumn("r", F.sum("v").over(w)), ["k", "id", "r"])
    got = _pdf(win.running(skewed, ["k"], ["id"], "v", "sum", "r"), ["k", "id", "r"])
    assert got.r.round(6).tolist() == want.r.round(6).tolist()


def test_running_max_without_partition(spark, skewed):
    w = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = _pdf(skewed.withColumn("r", F.max("v").over(w)), ["id", "k", "r"])
    got = _pdf(win.running(skewed, [], ["id"], "v", "max", "r"), ["id", "k", "r"])
    assert got.r.tolist() == want.r.tolist()


def test_rows_frame_and_shift_match_window(spark, skewed):
    w = Window.partitionBy("k").orderBy("id")
    want = _pdf(skewed.withColumn("a", F.avg("v").over(w.rowsBetween(-2, 1)))
                      .withColumn("lag", F.lag("v", 1, -1.0).over(w))
                      .withColumn("lead", F.lead("id", 2).over(w)), ["k", "id", "a", "lag", "lead"])
    a = win.rows_frame(skewed, ["k"], ["id"], "v", -2, 1, "avg", "a")
    b = win.shift(a, ["k"], ["id"], "v", 1, default=-1.0, out="lag")
    c = win.shift(b, ["k"], ["id"], "id", -2, out="lead")
    got = _pdf(c, ["k", "id", "a", "lag", "lead"])
    assert got.a.round(9).tolist() == want.a.round(9).tolist()
    assert got.lag.tolist() == want.lag.tolist()
    assert got.lead.fillna(-9).tolist() == want.lead.fillna(-9).tolist()


def test_ranks_match_window(spark, skewed):
    w = Window.partitionBy("k").orderBy("day")
    wu = Window.partitionBy("k").orderBy("day", "id")
    want = _pdf(skewed.select("k", "id", F.rank().over(w).alias("rank"), F.dense_rank().over(w).alias("dense_rank"),
                              F.percent_rank().over(w).alias("percent_rank"), F.cume_dist().over(w).alias("cume_dist"),
                              F.row_number().over(wu).alias("row_number"), F.ntile(7).over(wu).alias("ntile")),
                ["k", "id", "rank", "dense_rank", "percent_rank", "cume_dist", "row_number", "ntile"])
    got = _pdf(win.ranks(skewed, ["k"], ["day"], ["id"], ntile=7),
               ["k", "id", "rank", "dense_rank", "percent_rank", "cume_dist", "row_number", "ntile"])
    for c in ("rank", "dense_rank", "row_number", "ntile"):
        assert got[c].tolist() == want[c].tolist(), c
    for c in ("percent_rank", "cume_dist"):
        assert got[c].round(12).tolist() == want[c].round(12).tolist(), c


def test_range_frame_matches_window(spark, skewed):
    w = Window.partitionBy("k").orderBy("day").rangeBetween(-5, 0)
    want = _pdf(skewed.withColumn("s", F.sum("v").over(w)), ["k", "id", "s"])
    got = _pdf(win.range_frame(skewed, ["k"], "day", "v", -5, 0, "sum", "s"), ["k", "id", "s"])
    assert got.s.round(6).tolist() == want.s.round(6).tolist()


def test_index_within_groups_is_contiguous(spark, skewed):
    idx = index_within_groups(skewed, ["k"], ["id"], size_col="n").toPandas()
    for _, g in idx.groupby("k"):
        g = g.sort_values("id")
        assert g.idx.tolist() == list(range(len(g)))
        assert (g.n == len(g)).all()


@pytest.fixture(scope="module")
def nulls(spark):
    """NULL groups, orders and values, next to a hot group."""
    rows = [(None if i % 5 == 0 else (0 if i % 3 else 1 + i % 7), None if i % 11 == 0 else (i * 7) % 40, i,
             None if i % 4 == 0 or i < 60 else float(i % 13)) for i in range(600)]
    return spark.createDataFrame(rows, "k int, day int, id int, v double").repartition(5)


def _same(got, want, cols):
    key = lambda r: r["id"]
    a, b = (sorted((r.asDict() for r in df.select("id", *cols).collect()), key=key) for df in (got, want))
    for x, y in zip(a, b, strict=True):
        for c in ("id", *cols):
            assert x[c] == y[c] or x[c] is not None and y[c] is not None and abs(x[c] - y[c]) < 1e-9, (c, x, y)


@pytest.mark.parametrize("fn", ["sum", "count", "min", "max"])
def test_running_with_nulls(nulls, fn):
    w = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = nulls.withColumn("r", getattr(F, fn)("v").over(w))
    _same(win.running(nulls, ["k"], ["id"], "v", fn, "r", num_partitions=9), want, ["r"])


def test_shift_ranks_frames_and_totals_with_nulls(nulls):
    w = Window.partitionBy("k").orderBy("id")
    want = nulls.withColumns({"lag": F.lag("v", 1, -1.0).over(w), "lead": F.lead("v", 3).over(w), "m": F.max("v").over(w.rowsBetween(-1, 1)),
                              "n": F.count("v").over(w.rowsBetween(1, 2)), "t": F.sum("v").over(Window.partitionBy("k"))})
    got = win.shift(nulls, ["k"], ["id"], "v", 1, default=-1.0, out="lag")
    got = win.shift(got, ["k"], ["id"], "v", -3, out="lead")
    got = win.rows_frame(got, ["k"], ["id"], "v", -1, 1, "max", "m")
    got = win.rows_frame(got, ["k"], ["id"], "v", 1, 2, "count", "n")
    _same(win.group_total(got, ["k"], "v", "sum", "t"), want, ["lag", "lead", "m", "n", "t"])
    d = Window.partitionBy("k").orderBy("day")
    wu = Window.partitionBy("k").orderBy("day", "id")
    cols = {"rank": F.rank().over(d), "dense_rank": F.dense_rank().over(d), "percent_rank": F.percent_rank().over(d),
            "cume_dist": F.cume_dist().over(d), "row_number": F.row_number().over(wu), "ntile": F.ntile(4).over(wu)}
    _same(win.ranks(nulls, ["k"], ["day"], ["id"], ntile=4), nulls.withColumns(cols), list(cols))


@pytest.mark.parametrize("fn,lo,hi", [("sum", -5, 0), ("count", -2, 3), ("max", 1, 6), ("min", -40, 40)])
def test_range_frames_with_nulls(nulls, fn, lo, hi):
    w = Window.partitionBy("k").orderBy("day").rangeBetween(lo, hi)
    _same(win.range_frame(nulls, ["k"], "day", "v", lo, hi, fn, "r"), nulls.withColumn("r", getattr(F, fn)("v").over(w)), ["r"])


def test_average_ranks_keep_null_rows(nulls):
    from kiln.operators.stats import average_ranks
    r = average_ranks(nulls, "day")
    assert r.count() == nulls.count() and r.where("day is null and rank is not null").count() == 0
    days = sorted(x.day for x in nulls.collect() if x.day is not None)
    first = r.where(F.col("day") == days[0]).first()["rank"]
    assert first == (1 + days.count(days[0])) / 2


def test_lookup_beyond_the_broadcast_limit(spark):
    from kiln.operators.joins import join_small, lookup, measured_bytes
    big = spark.range(9000).select(F.when(F.col("id") % 3 > 0, F.lit(7)).when(F.col("id") % 30 == 0, F.lit(None))
                                   .otherwise(F.col("id") % 50).cast("int").alias("k"), "id")
    small = big.groupBy("k").agg(F.count("*").alias("n"), F.sum("id").alias("s"))
    want = sorted((tuple(r) for r in lookup(big, small, ["k"], "n").collect()), key=repr)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    got = lookup(big, small, ["k"], "n", limit_bytes=0, hot_rows=500)
    assert len(want) == 9000 and sorted((tuple(r) for r in got.collect()), key=repr) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    on_keys = [x.split("\n")[0] for x in plan.split("hashpartitioning(coalesce(k")[1:]]
    assert on_keys and all("_part" in x for x in on_keys), plan
    assert sorted((tuple(r) for r in join_small(big, small.drop("n"), ["k"], limit_bytes=0).collect()), key=repr) == want
    assert measured_bytes(spark.createDataFrame([("x" * 100, 1)], "a string, b int")) == 140


def test_no_exchange_on_the_group_alone(spark, skewed, monkeypatch):
    """With nothing broadcast, no shuffle of rows is on the group by itself."""
    from kiln.operators import joins
    monkeypatch.setattr(joins, "measured_bytes", lambda df: 1 << 60)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    dfs = (win.row_number(skewed, ["k"], ["id"]), win.ranks(skewed, ["k"], ["day"], ["id"]), win.running(skewed, ["k"], ["id"], "v", "sum", "r"),
           win.range_frame(skewed, ["k"], "day", "v", -5, 0, "sum", "s"), win.shift(skewed, ["k"], ["id"], "v", 1))
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in dfs]
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for plan in plans:
        assert "SortMergeJoin" in plan and not re.search(r"hashpartitioning\((k#\d+L?|coalesce\(k#\d+L?, 0\), isnull\(k#\d+L?\)), \d+, ENSURE", plan), plan


def test_keyed_reduce_last_merge_is_bounded(spark, monkeypatch):
    """However many tasks hold a hot key, its last merge sees few partials."""
    import numpy as np

    from kiln.operators import aggregates as agg
    monkeypatch.setattr(agg, "LAST_PARTIALS", 4)
    rows = spark.range(0, 4000, 1, 40).select(F.when(F.col("id") % 2 == 0, F.lit(1)).when(F.col("id") % 10 == 1, F.lit(None))
                                              .otherwise(F.col("id") % 7).cast("int").alias("k"), (F.col("id") % 17).cast("double").alias("v"))
    out = agg.keyed_reduce(rows, "k", "v", np.logaddexp)
    got = {r.k: r.v for r in out.collect()}
    want = {r.k: r.v for r in rows.groupBy("k").agg(F.log(F.sum(F.exp("v"))).alias("v")).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("FlatMapGroupsInPandas") == 2 and "pmod(SPARK_PARTITION_ID(), 4)" in plan


@pytest.mark.parametrize("band_rows", [1, 8192])
@pytest.mark.parametrize("lo,hi", [(-30, 5), (5, 60), (-60, -7), (-900, 900)])
def test_wide_frames_equal_windows_without_adding_up_each_frame(spark, monkeypatch, band_rows, lo, hi):
    monkeypatch.setattr(win, "BAND_ROWS", band_rows)
    rows = [("ab"[i % 2] if i % 5 else None, i, None if i % 3 == 0 else float(i * 37 % 101 - 50)) for i in range(600)]
    df = spark.createDataFrame(rows + [("c", i, None) for i in range(20)], "g string, i int, v double")
    outs = {"total": "sum", "n": "count", "least": "min", "most": "max", "mean": "avg"}
    got = win.rows_frames(df, ["g"], ["i"], "v", lo, hi, outs)
    w = Window.partitionBy("g").orderBy("i").rowsBetween(lo, hi)
    want = df.select("g", "i", "v", *(getattr(F, fn)("v").over(w).alias(out) for out, fn in outs.items()))
    pd.testing.assert_frame_equal(_pdf(got, want.columns), _pdf(want, want.columns))
    frames = re.findall(r"specifiedwindowframe\(\w+, ([^,]+), ([^)]+)\)", got._jdf.queryExecution().toString())
    assert frames and not any(re.fullmatch(r"-?\d+", a) and re.fullmatch(r"-?\d+", b) and a != b for a, b in frames)
