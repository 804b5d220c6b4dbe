"""Nested cross-validation as relational plans.

* ``cv_plan``: one row per (bucket, test_fold, val_fold), test != val.
* ``fold_moments`` / ``model_standardization``: population mean and std of
  every model's training folds, combined exactly from per-fold moments
  (count, mean, M2) -- never by re-reading the rows per model.
* ``score_assignments``: RMSE in target units of given models on given
  folds, with the network evaluated as Catalyst expressions (fixed
  weights); ``score_assignments_kernel`` does the same for per-model
  trained weights with a broadcast numpy kernel.
* ``choose_best`` / ``cv_report``: least validation error per test fold.

All model-level tables hold buckets x k x (k-1) rows: a bound fixed by the
parameters, which is why they may be broadcast.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MODEL_KEYS = ["bucket", "test_fold", "val_fold"]


def cv_plan(buckets: DataFrame, k: int, bucket_col: str = "bucket") -> DataFrame:
    """All (test, validation) fold pairs per bucket; the rest is training."""
    folds = F.sequence(F.lit(0), F.lit(k - 1))
    return (buckets.select(F.col(bucket_col).alias("bucket")).distinct()
            .withColumn("test_fold", F.explode(folds))
            .withColumn("val_fold", F.explode(folds))
            .filter(F.col("test_fold") != F.col("val_fold")))


def fold_moments(rows: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean and M2 (= n * var_pop) of each column per (bucket, fold)."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), (F.var_pop(c) * F.count(F.lit(1))).alias(f"{c}__m2")]
    return rows.groupBy("bucket", "fold").agg(*aggs)


def model_standardization(moments: DataFrame, plan: DataFrame, cols: list[str]) -> DataFrame:
    """Per model: training row count, mean and population std of ``cols``.

    Training folds of a model are the folds other than its test and
    validation folds.  Moments merge exactly (Chan et al.).
    """
    pairs = (plan.join(moments, "bucket")
                 .filter((F.col("fold") != F.col("test_fold")) & (F.col("fold") != F.col("val_fold"))))
    first = pairs.groupBy(*MODEL_KEYS).agg(
        F.sum("n").alias("n_train"),
        *[(F.sum(F.col("n") * F.col(f"{c}__mean")) / F.sum("n")).alias(f"{c}__gmean") for c in cols])
    second = (pairs.join(first, MODEL_KEYS)
                   .groupBy(*MODEL_KEYS, "n_train", *[f"{c}__gmean" for c in cols])
                   .agg(*[F.sum(F.col(f"{c}__m2") + F.col("n") * F.pow(F.col(f"{c}__mean") - F.col(f"{c}__gmean"), 2))
                          .alias(f"{c}__gm2") for c in cols]))
    out = [*MODEL_KEYS, F.col("n_train").cast("long").alias("n_train")]
    for c in cols:
        out.append(F.col(f"{c}__gmean").alias(f"{c}_mean"))
        out.append(F.sqrt(F.col(f"{c}__gm2") / F.col("n_train")).alias(f"{c}_std"))
    return second.select(*out)


def standardization_arrays(models: DataFrame, inputs: list[str], target: str) -> DataFrame:
    """Fold per-column stats into arrays: x_mean, x_std, t_mean, t_std."""
    return models.select(
        *MODEL_KEYS, "n_train",
        F.array(*[F.col(f"{c}_mean") for c in inputs]).alias("x_mean"),
        F.array(*[F.col(f"{c}_std") for c in inputs]).alias("x_std"),
        F.col(f"{target}_mean").alias("t_mean"), F.col(f"{target}_std").alias("t_std"))


def _weight(w, i: int) -> Column:
    if isinstance(w, Column):
        return F.element_at(w, i + 1)
    return F.lit(float(w[i]))


def forward_expr(inputs: list[Column], w, sizes: list[int]) -> Column:
    """Single network output as an expression; ``w`` = numpy vector or array Column."""
    offs, off = [], 0
    for li in range(len(sizes) - 1):
        r, c = sizes[li] + 1, sizes[li + 1]
        offs.append((off, r, c))
        off += r * c
    z = inputs
    for li, (o, r, c) in enumerate(offs):
        outs = []
        for j in range(c):
            s = _weight(w, o + j)                       # bias row (row 0)
            for i, zi in enumerate(z):
                s = s + zi * _weight(w, o + (i + 1) * c + j)
            outs.append(F.tanh(s) if li < len(offs) - 1 else s)
        z = outs
    return z[0]


def predict_column(inputs: list[str], sizes: list[int], w=None) -> Column:
    """Prediction in target units for rows joined to their model's columns
    ``x_mean``, ``x_std``, ``t_mean``, ``t_std`` (and ``w`` if not given).

    Constant input columns (std 0) standardise to 0; the output is
    unstandardised with the raw target std.
    """
    xs = []
    for i, c in enumerate(inputs):
        mu = F.element_at(F.col("x_mean"), i + 1)
        sd = F.element_at(F.col("x_std"), i + 1)
        xs.append(F.when(sd == 0, F.lit(0.0)).otherwise((F.col(c) - mu) / sd))
    weights = F.col("w") if w is None else w
    ys = forward_expr(xs, weights, sizes)
    return ys * F.col("t_std") + F.col("t_mean")


def add_prediction(df: DataFrame, inputs: list[str], sizes: list[int], w=None, out: str = "_yhat",
                   activations: str | None = None) -> DataFrame:
    """Append the network prediction (target units) as column ``out``, and
    with ``activations`` the outputs of all layers (array per layer, the
    standardised inputs first) under that name.

    One projection per layer: each unit is computed once per row and the
    next layer reads it as a column.  A single nested expression would
    repeat every earlier layer inside each unit (growing with depth) and
    fall out of whole-stage codegen.
    """
    keep = [F.col(c) for c in df.columns]
    z = []
    for i, c in enumerate(inputs):
        mu = F.element_at(F.col("x_mean"), i + 1)
        sd = F.element_at(F.col("x_std"), i + 1)
        z.append(F.when(sd == 0, F.lit(0.0)).otherwise((F.col(c) - mu) / sd).alias(f"_z0_{i}"))
    cur = df.select(*keep, *z)
    prev = [f"_z0_{i}" for i in range(len(inputs))]
    layers = [list(prev)]
    weights = F.col("w") if w is None else w
    off = 0
    n_layers = len(sizes) - 1
    for li in range(n_layers):
        r, c = sizes[li] + 1, sizes[li + 1]
        units = []
        for j in range(c):
            s_ = _weight(weights, off + j)
            for i, name in enumerate(prev):
                s_ = s_ + F.col(name) * _weight(weights, off + (i + 1) * c + j)
            units.append((F.tanh(s_) if li < n_layers - 1 else s_).alias(f"_z{li + 1}_{j}"))
        earlier = [name for layer in layers for name in layer] if activations else []
        cur = cur.select(*keep, *earlier, *units)
        prev = [f"_z{li + 1}_{j}" for j in range(c)]
        layers.append(list(prev))
        off += r * c
    result = [(F.col(prev[0]) * F.col("t_std") + F.col("t_mean")).alias(out)]
    if activations:
        result.append(F.array(*(F.array(*layer) for layer in layers)).alias(activations))
    return cur.select(*keep, *result)


def score_assignments(rows: DataFrame, assignments: DataFrame, inputs: list[str], target: str,
                      sizes: list[int], w=None, extra_keys: list[str] | None = None) -> DataFrame:
    """RMSE (target units) per assignment.

    ``assignments``: (bucket, fold, role, model keys, x_mean, x_std, t_mean,
    t_std[, w]) -- which model scores which fold.  Its size is bounded by
    buckets x k x (k-1), so it is broadcast; each data row meets only the
    models assigned to its own (bucket, fold).
    """
    keys = [*MODEL_KEYS, "role", *(extra_keys or [])]
    joined = rows.join(F.broadcast(assignments), ["bucket", "fold"])
    scored = add_prediction(joined, inputs, sizes, w)
    return (scored.withColumn("_err2", F.pow(F.col("_yhat") - F.col(target), 2))
                  .groupBy(*keys)
                  .agg(F.count(F.lit(1)).alias("n_scored"), F.sqrt(F.avg("_err2")).alias("rmse")))


def score_assignments_kernel(rows: DataFrame, assignments: DataFrame, inputs: list[str], target: str,
                             sizes: list[int], extra_keys: list[str] | None = None) -> DataFrame:
    """RMSE per assignment for models with their own weights (column ``w``).

    The assignment table (bounded by buckets x k x (k-1)) is broadcast once;
    a ``mapInPandas`` kernel scores each (bucket, fold) block of a batch for
    the models assigned to it and emits (assignment, n, sse) partials, so
    no weight array is copied onto data rows.
    """
    import pandas as pd
    from pyspark.sql import types as T

    from kiln.operators.layers import batch_loss_grad

    spark = rows.sparkSession
    keys = [*MODEL_KEYS, "role", *(extra_keys or [])]
    a = assignments.select(*dict.fromkeys([*keys, "fold", "x_mean", "x_std", "t_mean", "t_std", "w"])).toPandas()
    xs = np.stack(a["x_std"].to_numpy()).astype(float)
    ts = a["t_std"].to_numpy(float)
    payload = {
        "bucket": a["bucket"].to_numpy(np.int64), "fold": a["fold"].to_numpy(np.int64),
        "x_mean": np.stack(a["x_mean"].to_numpy()).astype(float), "x_sd": np.where(xs == 0, 1.0, xs),
        "x_const": xs == 0, "t_mean": a["t_mean"].to_numpy(float), "t_sd": np.where(ts == 0, 1.0, ts),
        "t_raw": ts, "w": np.stack(a["w"].to_numpy()).astype(float)}
    bc = spark.sparkContext.broadcast(payload)

    def kernel(batches):
        p = bc.value
        by_block = {}
        for j, (b, f) in enumerate(zip(p["bucket"], p["fold"])):
            by_block.setdefault((int(b), int(f)), []).append(j)
        acc = np.zeros((len(p["bucket"]), 2))
        for pdf in batches:
            if pdf.empty:
                continue
            blocks, blk = np.unique(pdf[["bucket", "fold"]].to_numpy(np.int64), axis=0, return_inverse=True)
            blk = blk.reshape(-1)
            X = pdf[inputs].to_numpy(dtype=float)
            Tt = pdf[target].to_numpy(dtype=float)
            for kv, (b, f) in enumerate(blocks.tolist()):
                js = by_block.get((b, f))
                if not js:
                    continue
                js = np.asarray(js)
                sel = blk == kv
                xb, tb = X[sel], Tt[sel]
                z = (xb[None] - p["x_mean"][js][:, None, :]) / p["x_sd"][js][:, None, :]
                z = np.where(p["x_const"][js][:, None, :], 0.0, z)
                tz = (tb[None, :] - p["t_mean"][js][:, None]) / p["t_sd"][js][:, None]
                n, sse, _ = batch_loss_grad(z, tz[:, :, None], np.ones((len(js), len(tb))), p["w"][js], sizes, False)
                acc[js, 0] += n
                acc[js, 1] += sse * p["t_raw"][js] ** 2        # back to target units
        hit = np.flatnonzero(acc[:, 0] > 0)
        if len(hit):
            yield pd.DataFrame({"a": hit.astype(np.int64), "n": acc[hit, 0], "sse": acc[hit, 1]})

    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("n", T.DoubleType()),
                           T.StructField("sse", T.DoubleType())])
    part = rows.select("bucket", "fold", *inputs, target).mapInPandas(kernel, schema)
    sums = part.groupBy("a").agg(F.sum("n").alias("n"), F.sum("sse").alias("sse")).toPandas()
    bc.unpersist()
    sums = sums.set_index("a").reindex(range(len(a))).fillna(0.0)
    out = a[keys].copy()
    out["n_scored"] = sums["n"].to_numpy().astype(np.int64)
    out["rmse"] = np.sqrt(sums["sse"].to_numpy() / np.where(sums["n"].to_numpy() > 0, sums["n"].to_numpy(), np.nan))
    return spark.createDataFrame(out, assignments.select(*keys).schema.add("n_scored", T.LongType())
                                 .add("rmse", T.DoubleType()))


def validation_assignments(models: DataFrame) -> DataFrame:
    return models.withColumn("fold", F.col("val_fold")).withColumn("role", F.lit("val"))


def choose_best(val_errors: DataFrame, k: int, mode: str = "per_fold") -> DataFrame:
    """Model of least validation RMSE for every (bucket, test_fold).

    ``per_fold``: among the k-1 models of that test fold; ties -> lower
    validation fold.  ``running``: the running minimum over all models met
    so far in (test, val) order, kept across test folds, first wins ties
    (a model trained on a later test fold can be chosen).
    """
    e = val_errors.select("bucket", "test_fold", "val_fold", F.col("rmse").alias("val_rmse"))
    if mode == "per_fold":
        best = e.groupBy("bucket", "test_fold").agg(
            F.min(F.struct("val_rmse", "val_fold")).alias("_b"))
        return best.select("bucket", "test_fold",
                           F.col("test_fold").alias("model_test_fold"),
                           F.col("_b.val_fold").alias("model_val_fold"),
                           F.col("_b.val_rmse").alias("min_val_rmse"))
    if mode == "running":
        w = (Window.partitionBy("bucket").orderBy("test_fold", "val_fold")
                   .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        run = e.withColumn("_b", F.min(F.struct("val_rmse", "test_fold", "val_fold")).over(w))
        last = Window.partitionBy("bucket", "test_fold").orderBy(F.col("val_fold").desc())
        run = run.withColumn("_r", F.row_number().over(last)).filter("_r = 1")
        return run.select("bucket", "test_fold",
                          F.col("_b.test_fold").alias("model_test_fold"),
                          F.col("_b.val_fold").alias("model_val_fold"),
                          F.col("_b.val_rmse").alias("min_val_rmse"))
    raise ValueError(f"unknown mode {mode!r}")


def test_assignments(best: DataFrame, models: DataFrame) -> DataFrame:
    """The chosen model of each test fold, assigned to that test fold."""
    m = models.withColumnRenamed("test_fold", "model_test_fold").withColumnRenamed("val_fold", "model_val_fold")
    return (best.select("bucket", "test_fold", "model_test_fold", "model_val_fold")
                .join(m.drop("n_train"), ["bucket", "model_test_fold", "model_val_fold"])
                .withColumn("fold", F.col("test_fold"))
                .withColumn("val_fold", F.col("model_val_fold"))
                .withColumn("role", F.lit("test")))


def cv_report(rows: DataFrame, models: DataFrame, inputs: list[str], target: str,
              sizes: list[int], k: int, mode: str = "per_fold", w=None, digits: int | None = None) -> DataFrame:
    """One row per (bucket, test_fold): samples, chosen model, errors.

    Fixed weights (``w`` given) are scored in Catalyst (checkable in SQL);
    per-model weights (column ``w``) by the broadcast numpy kernel.
    """
    def score(assign, extra=None):
        if w is None:
            return score_assignments_kernel(rows, assign, inputs, target, sizes, extra)
        return score_assignments(rows, assign, inputs, target, sizes, w, extra)

    val_err = score(validation_assignments(models))
    best = choose_best(val_err, k, mode)
    test_err = score(test_assignments(best, models), ["model_test_fold"])
    n_samples = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_samples"))
    rep = (best.join(test_err.select("bucket", "test_fold", F.col("rmse").alias("test_rmse")),
                     ["bucket", "test_fold"])
               .join(n_samples, "bucket"))
    cols = [F.col("bucket").cast("int").alias("bucket"), F.col("test_fold").cast("int").alias("test_fold"),
            F.col("n_samples").cast("long").alias("n_samples"),
            F.col("model_test_fold").cast("int").alias("model_test_fold"),
            F.col("model_val_fold").cast("int").alias("model_val_fold")]
    for c in ("min_val_rmse", "test_rmse"):
        cols.append((F.round(F.col(c), digits) if digits is not None else F.col(c)).alias(c))
    return rep.select(*cols)


def weights_literal_array(w: np.ndarray) -> Column:
    return F.array(*[F.lit(float(v)) for v in np.asarray(w, dtype=float)])


def write_report(report: DataFrame, path: str, fmt: str = "json") -> str:
    """One record per (bucket, test_fold), written by the executors (no
    collect to the driver); ``fmt`` json, parquet, or text (a JSON string
    per line)."""
    ordered = report.orderBy("bucket", "test_fold")
    if fmt == "text":
        ordered.select(F.to_json(F.struct(*report.columns)).alias("value")).write.mode("overwrite").text(path)
    else:
        ordered.write.mode("overwrite").format(fmt).save(path)
    return path
