"""Aggregation operators beyond a single built-in call."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.operators.indexing import index_within_groups
from kiln.session import partitions_for


def histogram(df: DataFrame, col: str, buckets) -> DataFrame:
    """Counts per bucket, all buckets listed (zeros included).

    ``buckets`` int n: n even buckets between min and max (one row reaches
    the driver for min/max).  A sorted list of boundaries: buckets [b_i,
    b_i+1), the last one closed.  NULL, NaN and out-of-range values are
    skipped.  Output: bucket (int), lo, hi, n (bigint).
    """
    x = F.col(col).cast("double")
    clean = df.select(x.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    if isinstance(buckets, int):
        if buckets < 1:
            raise ValueError("number of buckets must be >= 1")
        lo, hi = clean.agg(F.min("_x"), F.max("_x")).first()
        if lo is None:
            return df.sparkSession.createDataFrame([], "bucket int, lo double, hi double, n bigint")
        if lo == hi:
            bounds = [lo, hi]
            buckets = 1
        else:
            step = (hi - lo) / buckets
            bounds = [lo + i * step for i in range(buckets)] + [hi]
    else:
        bounds = [float(b) for b in buckets]
        if len(bounds) < 2 or any(a >= b for a, b in zip(bounds, bounds[1:])):
            raise ValueError("buckets must be sorted, unique, and at least two")
    n = len(bounds) - 1
    arr = F.array(*[F.lit(b) for b in bounds])
    # index = number of boundaries <= x, minus one; the last bucket is closed
    idx = F.size(F.filter(arr, lambda b: b <= F.col("_x"))) - 1
    idx = F.when(F.col("_x") == F.lit(bounds[-1]), F.lit(n - 1)).otherwise(idx)
    inside = (F.col("_x") >= F.lit(bounds[0])) & (F.col("_x") <= F.lit(bounds[-1]))
    counts = clean.where(inside).groupBy(idx.cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    edges = spark.createDataFrame([(i, bounds[i], bounds[i + 1]) for i in range(n)],
                                  "bucket int, lo double, hi double")
    return (edges.join(counts, "bucket", "left")
                 .select("bucket", "lo", "hi", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def describe_population(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, stddev (population, as the reference documents), min,
    max per column, one row per statistic, values as strings."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).cast("double").alias(f"count__{c}"), F.avg(x).alias(f"mean__{c}"),
                 F.stddev_pop(x).alias(f"stddev__{c}"), F.min(x).alias(f"min__{c}"), F.max(x).alias(f"max__{c}")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{s}', " + ", ".join(f"`{s}__{c}`" for c in cols) for s in STATISTICS)
    return wide.selectExpr(f"stack({len(STATISTICS)}, {stack}) AS (summary, {', '.join(cols)})")


STATISTICS = ("count", "mean", "stddev", "min", "max")


def describe_long(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """The same statistics in long form (summary, column, value double), from
    one scan."""
    by_column = ", ".join(f"'{c}', round(double({c}), {digits})" for c in cols)
    return describe_population(df, cols).selectExpr("summary", f"stack({len(cols)}, {by_column}) AS (column, value)")


def crosstab_long(df: DataFrame, a: str, b: str) -> DataFrame:
    """Contingency table in long form: (a, b, n) of the pairs that occur, NULL
    a value like any other.  No limit on the number of values."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, a: str, b: str, values: list[str] | None = None) -> DataFrame:
    """Contingency table: first column ``a_b``, one count column per value of
    ``b`` (zeros for absent pairs; ``null`` for NULL).  A wide table has the
    values of ``b`` as column names, so they are fetched unless given; use
    ``crosstab_long`` for many values."""
    name = F.coalesce(F.col(b).cast("string"), F.lit("null"))
    if values is None:
        values = sorted(r[0] for r in df.select(name).distinct().collect())
    t = (df.select(F.col(a).cast("string").alias(f"{a}_{b}"), name.alias("_b"))
           .groupBy(f"{a}_{b}").pivot("_b", values).count())
    return t.na.fill(0, subset=values)


def frequent_values(df: DataFrame, col: str, support: float) -> DataFrame:
    """Exact heavy hitters: values seen in at least ``support`` of the rows.
    The row total is one number on the driver; counts stay distributed."""
    total = df.count()
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= F.lit(support * total))


#: Keys a task of ``keyed_reduce`` holds before it sends their partials, and
#: the partials of one key that meet in the last merge at most.
HELD_KEYS, LAST_PARTIALS = 1 << 18, 64
#: Groups of keys, per 128 MB of input files, that ``keyed_reduce`` merges in a call each.
KEY_GROUPS = 16


def keyed_reduce(df: DataFrame, key: str, val: str, ufunc: np.ufunc, out_type: str = "double") -> DataFrame:
    """``reduceByKey`` with a user monoid given as a numpy ufunc, for monoids
    that no built-in aggregate expresses.

    A task keeps one partial per key (and sends them when it holds
    ``HELD_KEYS``), reduced whenever as many new rows have come.  A key's
    partials are merged in two levels: first per (key, one of
    ``LAST_PARTIALS`` salts), then per key, so the last merge of a key sees at
    most ``LAST_PARTIALS`` values however many tasks held it.  A call merges
    all keys of one of the groups.  NULL is a key, in a group of
    its own; NULL values are skipped.
    """
    narrow = df.select(F.col(key), F.col(val).cast(out_type).alias(val)).where(F.col(val).isNotNull())
    schema = narrow.schema

    def reduced(pdf: pd.DataFrame) -> pd.DataFrame:
        codes, keys = pd.factorize(pdf[key], sort=False, use_na_sentinel=False)
        order = np.argsort(codes, kind="stable")
        firsts = np.searchsorted(codes[order], np.arange(len(keys)))
        return pd.DataFrame({key: keys, val: ufunc.reduceat(pdf[val].to_numpy()[order], firsts)})

    def partial(batches):
        held, new = [], 0
        for pdf in batches:
            if len(pdf):
                held.append(pdf[[key, val]])
                new += len(pdf)
            if new >= HELD_KEYS:
                held, new = [reduced(pd.concat(held))], 0
                if len(held[0]) >= HELD_KEYS:
                    yield held.pop()
        if held:
            yield reduced(pd.concat(held))

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        return reduced(pdf[[key, val]])

    salt = F.pmod(F.spark_partition_id(), F.lit(LAST_PARTIALS))
    group = F.when(F.col(key).isNotNull(), F.pmod(F.xxhash64(key), F.lit(KEY_GROUPS * partitions_for(df, least=1))))
    salted = narrow.mapInPandas(partial, schema).withColumns({"_salt": salt, "_group": group})
    some = salted.groupBy("_group", "_salt").applyInPandas(merge, schema).withColumn("_group", group)
    return some.groupBy("_group").applyInPandas(merge, schema)


def grouped_values(df: DataFrame, key: str, val: str, order: list[str] | None = None) -> DataFrame:
    """``groupByKey`` in long form: (key, pos, value) with pos 0.. inside the
    key in value order.  A hot key stays spread over many partitions; no
    list of a whole group is built."""
    order = order or [val]
    return index_within_groups(df.select(key, val, *[c for c in order if c != val]), [key], order,
                               index_col="pos")


def tree_aggregate(df: DataFrame, aggs: list, fanout: int = 16) -> DataFrame:
    """Two-level aggregation (``treeAggregate``): partial results per salt
    bucket first, then one global merge of at most ``fanout`` rows.  Only
    for decomposable aggregates given as (name, fn) with fn in sum/min/max/count.
    """
    salted = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(fanout)))
    first_fn = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
    first = salted.groupBy("_salt").agg(*[first_fn[fn](c).alias(n) for n, fn, c in aggs])
    merge = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
    return first.agg(*[merge[fn](n).alias(n) for n, fn, _ in aggs])


def clt_estimate(df: DataFrame, col: str, fraction: float, seed: int = 0, confidence: float = 0.95) -> DataFrame:
    """Estimate count, sum and mean of ``col`` from a Bernoulli sample with a
    normal-approximation interval (``countApprox`` / ``sumApprox`` /
    ``meanApprox`` without the time-out job control)."""
    from statistics import NormalDist
    z = NormalDist().inv_cdf(0.5 + confidence / 2)
    s = df.select(F.col(col).cast("double").alias("_v")).sample(False, fraction, seed)
    a = s.agg(F.count(F.lit(1)).alias("m"), F.sum("_v").alias("sv"), F.avg("_v").alias("mean"),
              F.var_samp("_v").alias("var"))
    p = F.lit(fraction)
    cnt = F.col("m") / p
    cnt_se = F.sqrt(F.col("m") * (1 - p)) / p
    tot = F.col("sv") / p
    mean_se = F.sqrt(F.col("var") / F.col("m"))
    tot_se = cnt * mean_se
    cells = (("count", cnt, cnt_se), ("sum", tot, tot_se), ("mean", F.col("mean"), mean_se))
    one = a.select(F.explode(F.array(*(
        F.struct(F.lit(name).alias("stat"), est.alias("estimate"), (est - F.lit(z) * se).alias("low"),
                 (est + F.lit(z) * se).alias("high"), F.lit(confidence).alias("confidence")) for name, est, se in cells))).alias("x"))
    return one.select("x.*")
