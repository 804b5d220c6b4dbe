"""Statistics and evaluation metrics as distributed aggregates.

Ranks are global here (Spearman, AUC).  They are computed per distinct
value: counts per value, then a running sum over the (skew-safe) sorted
distinct values, so a heavily repeated value is one row, not a hot group.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.operators import windows as win
from kiln.operators.joins import join_on, lookup


def col_stats(df: DataFrame, array_col: str) -> DataFrame:
    """Per dimension: count, mean, sample variance, non-zeros, max, min,
    L1 and L2 norm (``colStats``)."""
    x = df.select(F.posexplode(F.col(array_col).cast("array<double>")).alias("dim", "v"))
    return x.groupBy("dim").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.var_samp("v").alias("variance"),
        F.count_if(F.col("v") != 0).alias("num_nonzeros"), F.max("v").alias("max"), F.min("v").alias("min"),
        F.sum(F.abs("v")).alias("norm_l1"), F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm_l2"))


def average_ranks(df: DataFrame, col: str, out: str = "rank") -> DataFrame:
    """1-based ranks of ``col`` over the whole frame, ties get the average;
    NULL has no rank."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_c"))
    run = win.running(counts, [], [col], "_c", "sum", "_cum")
    ranks = run.select(col, (F.col("_cum") - F.col("_c") + (F.col("_c") + 1) / 2.0).alias(out), "_c")
    return lookup(df, ranks, [col], "_c", "left")


def correlation_matrix(df: DataFrame, cols: list[str], method: str = "pearson", id_col: str | None = None) -> DataFrame:
    """Long form (i, j, corr) for all column pairs, each over the rows that
    have both values; Spearman = Pearson of average ranks among those rows.
    (Rows need no id: ``id_col`` is kept for callers that name one.)"""
    n = len(cols)
    if method == "spearman":
        gaps = df.agg(*(F.count_if(F.col(c).isNull()).alias(f"_{k}") for k, c in enumerate(cols))).first()
        if any(gaps):
            return _spearman_with_gaps(df.select(*cols), cols, gaps)
        base, use = df.select(*cols), [f"{c}__r" for c in cols]
        for c, r in zip(cols, use):
            base = average_ranks(base, c, r)
    elif method == "pearson":
        base, use = df, cols
    else:
        raise ValueError(f"unknown method {method!r}")
    # all pairs in one aggregate; stack turns its row into the long form
    wide = base.agg(*(F.corr(use[i], use[j]).alias(f"c_{i}_{j}") for i in range(n) for j in range(n)))
    cells = ", ".join(f"'{cols[i]}', '{cols[j]}', c_{i}_{j}" for i in range(n) for j in range(n))
    return wide.selectExpr(f"stack({n * n}, {cells}) AS (i, j, corr)")


def _spearman_with_gaps(df: DataFrame, cols: list[str], gaps) -> DataFrame:
    """Pair by pair: which rows count, and so the ranks, differ."""
    out = []
    for i, a in enumerate(cols):
        for j in range(i, len(cols)):
            x = df.select(F.col(a).alias("x"), F.col(cols[j]).alias("y"))
            if gaps[i] or gaps[j]:
                x = x.where("x is not null and y is not null")
            one = average_ranks(average_ranks(x, "x", "rx"), "y", "ry").agg(F.corr("rx", "ry").alias("corr"))
            out += [one.select(F.lit(p).alias("i"), F.lit(q).alias("j"), "corr") for p, q in dict.fromkeys([(a, cols[j]), (cols[j], a)])]
    return reduce(lambda p, q: p.unionByName(q), out)


def _chi2_sf(x: float, k: int) -> float:
    """Upper tail of the chi-square distribution (regularised gamma Q)."""
    if x <= 0:
        return 1.0
    a, z = k / 2.0, x / 2.0
    if z < a + 1:   # series for P, then Q = 1 - P
        term = total = 1.0 / a
        n = a
        for _ in range(1000):
            n += 1
            term *= z / n
            total += term
            if abs(term) < abs(total) * 1e-15:
                break
        return max(0.0, 1.0 - total * math.exp(-z + a * math.log(z) - math.lgamma(a)))
    b = z + 1 - a   # continued fraction for Q
    c, d = 1e300, 1 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1e-300 if abs(d) < 1e-300 else d
        c = b + an / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1 / d
        delta = d * c
        h *= delta
        if abs(delta - 1) < 1e-15:
            break
    return math.exp(-z + a * math.log(z) - math.lgamma(a)) * h


def chi_square_independence(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson chi-square test of independence of two categorical columns.

    Sum over all cells of (o - e)^2 / e equals sum over observed cells of
    o^2 / e minus n (empty cells contribute their e, and sum e = n), so
    only the observed contingency cells are aggregated -- no grid of all
    value pairs is built.  Rows that lack a value don't count; without any
    complete row the statistic is 0.
    """
    df = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    cells = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("o"))
    ra = df.groupBy(a).agg(F.count(F.lit(1)).alias("ra"))
    cb = df.groupBy(b).agg(F.count(F.lit(1)).alias("cb"))
    n = float(df.count())
    j = cells.join(ra, a).join(cb, b)
    e = F.col("ra") * F.col("cb") / F.lit(n)
    row = j.agg(F.sum(F.col("o") * F.col("o") / e).alias("s"), F.countDistinct(a).alias("na"),
                F.countDistinct(b).alias("nb")).first()
    stat = float(row["s"] or 0.0) - n
    dof = max(0, row["na"] - 1) * max(0, row["nb"] - 1)
    return df.sparkSession.createDataFrame([(stat, dof, float(_chi2_sf(stat, dof)) if dof > 0 else 1.0)],
                                           "statistic double, dof int, p_value double")


def chi_square_goodness_of_fit(df: DataFrame, col: str, expected: dict) -> DataFrame:
    """Observed counts of ``col`` against expected proportions."""
    # only the expected categories reach the driver (bounded by the caller)
    keys = list(expected)
    obs = {r[0]: r[1] for r in df.where(F.col(col).isin(keys)).groupBy(col).count().collect()}
    others = df.where(~F.col(col).isin(keys) | F.col(col).isNull()).limit(1).count()
    if others:
        raise ValueError(f"{col} has values outside the expected categories")
    n = float(sum(obs.values()))
    tot = float(sum(expected.values()))
    stat = sum((obs.get(k, 0) - n * v / tot) ** 2 / (n * v / tot) for k, v in expected.items())
    dof = len(expected) - 1
    return df.sparkSession.createDataFrame([(stat, dof, float(_chi2_sf(stat, dof)))],
                                           "statistic double, dof int, p_value double")


def kolmogorov_smirnov(df: DataFrame, col: str, cdf: Callable[[Column], Column], exact_rows: int = 140) -> DataFrame:
    """One-sample test of ``col`` against a distribution function (a Column of
    a Column): (n, statistic, location, p_value).

    The statistic is the largest distance between the function and the
    empirical distribution, before and after its step at each distinct value;
    steps come from counts per value and a running sum over the sorted values,
    so ties are one row and no task holds all values.  ``location``: the
    least value with that distance.  The p-value is exact (a power of a
    matrix) up to ``exact_rows`` values, else the limit distribution's.  NULL
    and NaN don't count; an empty table gives NULL and a p-value of 1."""
    x = F.col(col).cast("double")
    counts = df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x")).groupBy("x").agg(F.count(F.lit(1)).alias("c"))
    steps = win.running(counts, [], ["x"], "c", "sum", "upto")
    n = int(counts.agg(F.sum("c")).first()[0] or 0)
    at = cdf(F.col("x"))
    d = F.greatest(F.col("upto") / F.lit(float(max(1, n))) - at, at - (F.col("upto") - F.col("c")) / F.lit(float(max(1, n))))
    top = steps.agg(F.max(d).alias("statistic"), F.max_by(-F.col("x"), F.struct(d.alias("d"), (-F.col("x")).alias("x"))).alias("_at"))
    p = F.pandas_udf(lambda s: s.map(lambda v: ks_p_value(v, n, exact_rows)), "double")
    return top.select(F.lit(n).cast("bigint").alias("n"), "statistic", (-F.col("_at")).alias("location"),
                      F.when(F.col("statistic").isNull(), 1.0).otherwise(p("statistic")).alias("p_value"))


def ks_p_value(d: float | None, n: int, exact_rows: int = 140) -> float:
    """Probability of a distance of ``d`` or more for n values from the
    distribution: exact by the matrix of Marsaglia, Tsang and Wang (2003) up
    to ``exact_rows``, else the limit series at Stephens' corrected argument."""
    if d is None or d != d or n == 0 or d <= 0:
        return 1.0
    if d >= 1:
        return 0.0
    if n > exact_rows:
        t = d * (math.sqrt(n) + 0.12 + 0.11 / math.sqrt(n))
        if t < 0.3:
            return 1.0
        return min(1.0, max(0.0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * t * t) for k in range(1, 101))))
    k = int(n * d) + 1
    m, h = 2 * k - 1, k - n * d
    i, j = np.indices((m, m))
    matrix = (i - j + 1 >= 0).astype(float)
    edge = h ** np.arange(1, m + 1)
    matrix[:, 0] -= edge
    matrix[-1, :] -= edge[::-1]
    matrix[-1, 0] += max(0.0, 2 * h - 1) ** m
    matrix /= np.array([[math.factorial(max(0, a - b + 1)) for b in range(m)] for a in range(m)], float)
    power = np.linalg.matrix_power(matrix, n)
    log_scale = math.lgamma(n + 1) - n * math.log(n)
    inside = power[k - 1, k - 1]
    return float(min(1.0, max(0.0, 1.0 - math.exp(log_scale + math.log(inside))))) if inside > 0 else 1.0


def kernel_density(df: DataFrame, col: str, points: list[float], bandwidth: float = 1.0) -> DataFrame:
    """Gaussian kernel density estimate at each point: one average per point,
    all in one aggregate."""
    h = float(bandwidth)
    norm = 1.0 / (h * math.sqrt(2 * math.pi))
    points = [float(p) for p in points]
    wide = df.agg(*(F.avg(F.exp(-F.pow((F.col(col) - p) / h, 2) / 2) * norm).alias(f"d{i}") for i, p in enumerate(points)))
    cells = ", ".join(f"double({p!r}), d{i}" for i, p in enumerate(points))
    return wide.selectExpr(f"stack({len(points)}, {cells}) AS (point, density)")


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under ROC by the rank-sum (Mann-Whitney) identity, ties averaged."""
    r = average_ranks(df.select(score, label), score, "_r")
    s = r.agg(F.sum(F.when(F.col(label) == 1, F.col("_r"))).alias("rp"),
              F.count_if(F.col(label) == 1).alias("np"), F.count_if(F.col(label) != 1).alias("nn"))
    return s.select(((F.col("rp") - F.col("np") * (F.col("np") + 1) / 2) / (F.col("np") * F.col("nn"))).alias("auc"),
                    F.col("np").alias("n_pos"), F.col("nn").alias("n_neg"))


def regression_metrics(df: DataFrame, pred: str, label: str) -> DataFrame:
    """Explained variance (mean squared distance of the predictions from the
    mean label), MAE, MSE, RMSE and R2 of the rows that have both values.
    Variances are centred aggregates, so large means lose no digits."""
    y, p = F.col(label).cast("double"), F.col(pred).cast("double")
    a = df.where(y.isNotNull() & p.isNotNull()).agg(
        F.avg(p - y).alias("bias"), F.var_pop(p).alias("vp"), F.var_pop(y).alias("vy"),
        F.avg(F.pow(p - y, 2)).alias("mse"), F.avg(F.abs(p - y)).alias("mae"))
    return a.select((F.col("vp") + F.pow("bias", F.lit(2))).alias("explained_variance"), "mae", "mse",
                    F.sqrt("mse").alias("rmse"), (1 - F.col("mse") / F.col("vy")).alias("r2"))


def confusion_matrix(df: DataFrame, pred: str, label: str) -> DataFrame:
    """(label, prediction, n) of the pairs that occur."""
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def multiclass_metrics(df: DataFrame, pred: str, label: str) -> DataFrame:
    """Per label support, true positives, precision, recall, F1 and false
    positive rate, from one confusion count: each of its rows adds to the
    support of its label and to the predictions of its prediction."""
    hit = F.col("label").eqNullSafe(F.col("prediction"))
    zero = F.lit(0).cast("bigint")
    row = F.struct(F.col("label").alias("label"), F.col("n").alias("support"), zero.alias("predicted"), F.when(hit, F.col("n")).otherwise(zero).alias("tp"))
    col = F.struct(F.col("prediction").alias("label"), zero.alias("support"), F.col("n").alias("predicted"), zero.alias("tp"))
    m = (confusion_matrix(df, pred, label).select(F.explode(F.array(row, col)).alias("x")).select("x.*")
         .groupBy("label").agg(*(F.sum(c).alias(c) for c in ("support", "predicted", "tp")))
         .withColumn("total", F.sum("support").over(Window.partitionBy())))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
    others = F.col("total") - F.col("support")
    fpr = F.when(others > 0, (F.col("predicted") - F.col("tp")) / others).otherwise(0.0)
    return m.select("label", "support", "tp", prec.alias("precision"), rec.alias("recall"), f1.alias("f1"),
                    fpr.alias("false_positive_rate"))


def weighted_multiclass_metrics(df: DataFrame, pred: str, label: str) -> DataFrame:
    """Accuracy and the per-label figures averaged by support, one row."""
    m = multiclass_metrics(df, pred, label)
    total = F.sum("support")
    return m.agg((F.sum("tp") / total).alias("accuracy"), *(
        (F.sum(F.col(c) * F.col("support")) / total).alias(f"weighted_{c}")
        for c in ("precision", "recall", "f1", "false_positive_rate")))


def ranking_metrics(ranked: DataFrame, relevant: DataFrame, qid: str, item: str, pos: str, k: int) -> DataFrame:
    """Mean precision@k, MAP and NDCG@k over queries.

    ``ranked``: (qid, item, pos 0-based) predicted order; ``relevant``:
    (qid, item) ground truth.  Queries without relevant items count 0 (as
    the reference's metrics do).  A NULL query or item is one like any other.
    """
    rel = relevant.select(qid, item).distinct().withColumn("_rel", F.lit(1))
    n_rel = rel.groupBy(qid).agg(F.count(F.lit(1)).alias("_nrel"))
    r = join_on(ranked.select(qid, item, pos), rel, [qid, item], "left").fillna(0, subset=["_rel"])
    # hits before and at each position, for average precision
    r = win.running(r, [qid], [pos], "_rel", "sum", "_hits")
    per_q = r.groupBy(qid).agg(
        F.sum(F.when(F.col(pos) < k, F.col("_rel")).otherwise(0)).alias("_hits_k"),
        F.sum(F.when(F.col("_rel") == 1, F.col("_hits") / (F.col(pos) + 1)).otherwise(0.0)).alias("_ap_sum"),
        F.sum(F.when((F.col(pos) < k) & (F.col("_rel") == 1), 1 / F.log2(F.col(pos) + 2)).otherwise(0.0)).alias("_dcg"))
    per_q = join_on(per_q, n_rel, [qid], "left").fillna(0, subset=["_nrel"])
    # ideal DCG: the first min(n_rel, k) positions all relevant
    idcg = F.aggregate(F.sequence(F.lit(0), F.least(F.col("_nrel"), F.lit(k)) - 1), F.lit(0.0),
                       lambda acc, i: acc + 1 / F.log2(i + 2))
    per_q = per_q.withColumn("_idcg", F.when(F.col("_nrel") > 0, idcg).otherwise(0.0))
    return per_q.agg(
        F.avg(F.col("_hits_k") / F.lit(k)).alias("precision_at_k"),
        F.avg(F.when(F.col("_nrel") > 0, F.col("_ap_sum") / F.col("_nrel")).otherwise(0.0)).alias("mean_avg_precision"),
        F.avg(F.when(F.col("_idcg") > 0, F.col("_dcg") / F.col("_idcg")).otherwise(0.0)).alias("ndcg_at_k"),
        F.count(F.lit(1)).alias("n_queries"))


def multilabel_metrics(df: DataFrame, pred: str, label: str, n_labels: int) -> DataFrame:
    """Subset accuracy, accuracy, Hamming loss, precision, recall, F1 and
    micro averages, for array label / prediction sets.  NULL counts as the
    empty set.  Two empty sets are equal: their accuracy and F1 are 1, and so
    are the micro averages of a table with empty sets only; the precision of an
    empty prediction and the recall of an empty label set are 0."""
    empty = F.array().cast(df.schema[label].dataType)
    p, l = F.array_distinct(F.coalesce(F.col(pred), empty)), F.array_distinct(F.coalesce(F.col(label), empty))
    inter = F.size(F.array_intersect(p, l))
    union = F.size(F.array_union(p, l))
    x = df.select(inter.alias("i"), union.alias("u"), F.size(p).alias("np"), F.size(l).alias("nl"),
                  (F.array_sort(p) == F.array_sort(l)).alias("eq"))
    n = F.count(F.lit(1))

    def micro(part: Column, whole: Column) -> Column:
        none = F.sum(F.col("np") + F.col("nl")) == 0
        return F.when(none, 1.0).when(whole == 0, 0.0).otherwise(F.try_divide(part, whole))

    return x.agg(
        F.avg(F.col("eq").cast("double")).alias("subset_accuracy"),
        F.avg(F.when(F.col("u") == 0, 1.0).otherwise(F.try_divide("i", "u"))).alias("accuracy"),
        F.try_divide(F.sum(F.col("np") + F.col("nl") - 2 * F.col("i")), n * F.lit(n_labels)).alias("hamming_loss"),
        F.avg(F.when(F.col("np") > 0, F.col("i") / F.col("np")).otherwise(0.0)).alias("precision"),
        F.avg(F.when(F.col("nl") > 0, F.col("i") / F.col("nl")).otherwise(0.0)).alias("recall"),
        F.avg(F.when(F.col("u") == 0, 1.0).otherwise(F.try_divide(2 * F.col("i"), F.col("np") + F.col("nl")))).alias("f1"),
        micro(F.sum("i"), F.sum("np")).alias("micro_precision"), micro(F.sum("i"), F.sum("nl")).alias("micro_recall"),
        micro(2 * F.sum("i"), F.sum("np") + F.sum("nl")).alias("micro_f1"))


def multilabel_label_metrics(df: DataFrame, pred: str, label: str) -> DataFrame:
    """Per label precision, recall and F1 for array label / prediction sets."""
    p, l = F.array_distinct(F.col(pred)), F.array_distinct(F.col(label))
    one = (df.select(F.explode(F.array_union(p, l)).alias("label"), p.alias("p"), l.alias("l"))
           .groupBy("label").agg(F.count_if(F.array_contains("p", F.col("label")) & F.array_contains("l", F.col("label"))).alias("tp"),
                                 F.count_if(F.array_contains("p", F.col("label"))).alias("predicted"),
                                 F.count_if(F.array_contains("l", F.col("label"))).alias("support")))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
    return one.select("label", "support", prec.alias("precision"), rec.alias("recall"), f1.alias("f1"))
