"""Models updated per micro-batch (streaming k-means, streaming linear SGD).

The model itself (k centres, or d weights) is small; every batch is scored
and summarised by Spark jobs (built-in array expressions, partial
aggregates), and only the k x d / d-sized summaries come back.  Each batch
starts from the snapshot written under the batch id before its own and
writes its own, so a repeated batch or a restart changes nothing.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.session import scratch_path
from kiln.streaming import runner


def _dot(arr: Column, vec: np.ndarray) -> Column:
    lit = F.array(*[F.lit(float(v)) for v in vec])
    return F.aggregate(F.zip_with(arr, lit, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)


def _sqdist(arr: Column, vec: np.ndarray) -> Column:
    lit = F.array(*[F.lit(float(v)) for v in vec])
    return F.aggregate(F.zip_with(arr, lit, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, v: acc + v)


def assign_clusters(df: DataFrame, col: str, centres: np.ndarray) -> DataFrame:
    """Nearest centre by squared distance, computed JVM-side."""
    x = F.col(col).cast("array<double>")
    d = F.array(*[_sqdist(x, c) for c in centres])
    return df.withColumn("cluster", (F.array_position(d, F.array_min(d)) - 1).cast("int"))


def cluster_sums(assigned: DataFrame, col: str, k: int, dim: int):
    """(counts (k,), vector sums (k, d)) as one small aggregate."""
    ex = assigned.select("cluster", F.posexplode(F.col(col).cast("array<double>")).alias("pos", "v"))
    sums = ex.groupBy("cluster", "pos").agg(F.sum("v").alias("s")).collect()
    counts = assigned.groupBy("cluster").count().collect()
    m = np.zeros(k)
    xs = np.zeros((k, dim))
    for r in counts:
        m[r["cluster"]] = r["count"]
    for r in sums:
        xs[r["cluster"], r["pos"]] = r["s"]
    return m, xs


def kmeans_update(centres: np.ndarray, weights: np.ndarray, m: np.ndarray, xs: np.ndarray, decay: float):
    """c' = (c n a + sum x) / (n a + m),  n' = n a + m  (clusters with no
    new points keep their centre and only decay)."""
    nw = weights * decay + m
    safe = np.where(nw > 0, nw, 1.0)
    newc = np.where((m > 0)[:, None], (centres * (weights * decay)[:, None] + xs) / safe[:, None], centres)
    return newc, nw


def _before(spark: SparkSession, out: str, batch_id: int) -> DataFrame | None:
    """The model after the batch before this one, read from what was
    committed: a restarted or repeated batch starts from the same model."""
    return spark.read.parquet(f"{out}/b={batch_id - 1}") if batch_id else None


def last_centres(history: DataFrame) -> np.ndarray:
    return _kmeans_model(history)[0]


def _kmeans_model(history: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    last = history.agg(F.max("batch_id")).first()[0]
    rows = history.where(F.col("batch_id") == last).orderBy("cluster").collect()          # k centres
    return np.array([r["centre"] for r in rows]), np.array([r["weight"] for r in rows])


def last_weights(history: DataFrame) -> np.ndarray:
    return np.array(history.orderBy(F.desc("batch_id")).first()["weights"])


def predict_linear(df: DataFrame, xcol: str, w: np.ndarray, logistic: bool = False, out: str = "prediction") -> DataFrame:
    z = _dot(F.col(xcol).cast("array<double>"), w)
    return df.withColumn(out, 1 / (1 + F.exp(-z)) if logistic else z)


def streaming_kmeans(stream: DataFrame, col: str, k: int, decay: float = 1.0, seed: int = 0,
                     name: str = "kmeans", dim: int | None = None, time_unit: str = "batches") -> DataFrame:
    """Centres after each batch.  Old points lose weight by ``decay`` per
    batch, or per new point (``time_unit`` "batches" or "points")."""
    if time_unit not in ("batches", "points"):
        raise ValueError(f"unknown time unit {time_unit!r}")
    spark = stream.sparkSession
    out = scratch_path(spark, f"{name}-centres")

    def each(batch: DataFrame, batch_id: int):
        first = batch.select(col).first()
        if batch_id:
            centres, weights = _kmeans_model(_before(spark, out, batch_id))
        elif first is None and dim is None:
            raise ValueError("give dim: the first batch has no vector to take it from")
        else:
            centres = np.random.default_rng(seed).normal(size=(k, dim or len(first[0])))
            weights = np.zeros(k)
        m, xs = cluster_sums(assign_clusters(batch, col, centres), col, k, centres.shape[1])
        fade = decay if time_unit == "batches" else decay ** m.sum()
        centres, weights = kmeans_update(centres, weights, m, xs, fade)
        rows = [(int(batch_id), i, float(weights[i]), [float(v) for v in centres[i]]) for i in range(k)]
        spark.createDataFrame(rows, "batch_id long, cluster int, weight double, centre array<double>") \
             .write.mode("overwrite").parquet(f"{out}/b={batch_id}")

    runner.run_foreach(stream, name, each, mode="append")
    return spark.read.parquet(out).drop("b")


def streaming_linear_sgd(stream: DataFrame, xcol: str, ycol: str, n_features: int, step: float = 0.1,
                         iters_per_batch: int = 1, name: str = "sgd", logistic: bool = False) -> DataFrame:
    """Online least squares (or logistic) regression: a few full-gradient
    steps per batch; gradient = one posexplode + groupBy(pos) aggregate."""
    spark = stream.sparkSession
    out = scratch_path(spark, f"{name}-weights")

    def each(batch: DataFrame, batch_id: int):
        b = batch.select(F.col(xcol).cast("array<double>").alias("x"), F.col(ycol).cast("double").alias("y"))
        w = last_weights(_before(spark, out, batch_id)) if batch_id else np.zeros(n_features)
        loss = None
        for _ in range(iters_per_batch):
            r = predict_linear(b, "x", w, logistic).withColumn("_err", F.col("prediction") - F.col("y"))
            g = (r.select(F.posexplode("x").alias("pos", "xi"), "_err")
                  .groupBy("pos").agg(F.avg(F.col("xi") * F.col("_err")).alias("g")).collect())
            grad = np.zeros(n_features)
            for row in g:
                grad[row["pos"]] = row["g"]
            loss = r.agg(F.avg(F.col("_err") * F.col("_err"))).first()[0]
            w = w - step * grad
        spark.createDataFrame([(int(batch_id), [float(v) for v in w], float(loss or 0.0))],
                              "batch_id long, weights array<double>, mse double") \
             .write.mode("overwrite").parquet(f"{out}/b={batch_id}")

    runner.run_foreach(stream, name, each, mode="append")
    return spark.read.parquet(out).drop("b")
