"""Streaming: batch answer == stream answer, restart from checkpoint,
life cycle, and the per-batch model updates (T13-T15, T17, T18)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from kiln.session import scratch_path
from kiln.sources.tables import table
from kiln.streaming import models, runner

from kiln_cases import SF_SMALL


def test_restart_from_checkpoint_continues(spark):
    ev = table(spark, SF_SMALL, "events")
    path = scratch_path(spark, "restart-in")
    out, ck = scratch_path(spark, "restart-out"), scratch_path(spark, "restart-ck")
    ev.where("event_id < 500").write.mode("append").parquet(path)
    agg = (spark.readStream.schema(ev.schema).parquet(path)
                .groupBy("event_type").agg(F.count(F.lit(1)).alias("n")))

    def snap(batch, batch_id):
        batch.write.mode("overwrite").parquet(out)

    def run():
        q = agg.writeStream.outputMode("complete").option("checkpointLocation", ck).foreachBatch(snap) \
               .trigger(availableNow=True).start()          # lifecycle: start / await / inactive
        q.awaitTermination(300)
        assert not q.isActive and q.exception() is None

    run()
    assert spark.read.parquet(out).agg(F.sum("n")).first()[0] == 500
    ev.where("event_id >= 500").write.mode("append").parquet(path)     # new files arrive
    run()                                                               # restart from the checkpoint
    assert spark.read.parquet(out).agg(F.sum("n")).first()[0] == ev.count()


def test_kmeans_update_rule():
    c = np.array([[0.0, 0.0], [10.0, 10.0]])
    w = np.array([2.0, 0.0])
    m = np.array([2.0, 0.0])
    xs = np.array([[4.0, 4.0], [0.0, 0.0]])
    nc, nw = models.kmeans_update(c, w, m, xs, decay=0.5)
    assert np.allclose(nc[0], [4.0 / 3.0, 4.0 / 3.0])      # (0*2*0.5 + 4) / (1 + 2)
    assert np.allclose(nc[1], [10.0, 10.0]) and np.allclose(nw, [3.0, 0.0])


def test_streaming_kmeans_and_sgd_run(spark):
    e = table(spark, SF_SMALL, "embeddings").select("vec_id", "embedding")
    cents = models.streaming_kmeans(runner.stage(e, "km", 3, "vec_id").stream(spark), "embedding", k=3, seed=1, name="km")
    assert cents.select("batch_id").distinct().count() == 3
    assert cents.where("batch_id = 2").agg(F.sum("weight")).first()[0] == e.count()   # decay 1: all points
    x = spark.range(3000).select(F.col("id").alias("rid"), F.array((F.col("id") % 10 / 10.0).cast("double")).alias("x")) \
             .withColumn("y", F.col("x")[0] * 3.0)
    hist = models.streaming_linear_sgd(runner.stage(x, "sgd", 3, "rid").stream(spark), "x", "y", 1, step=0.5,
                                       iters_per_batch=20, name="sgd").orderBy("batch_id").toPandas()
    assert abs(hist.weights.iloc[-1][0] - 3.0) < 0.3
    assert hist.mse.iloc[-1] < hist.mse.iloc[0]


def test_memory_console_sinks_and_slice(spark, capsys):
    ev = table(spark, SF_SMALL, "events")
    stream = runner.stage(ev, "sinks", 4, "event_id").stream(spark)
    q = (stream.groupBy("event_type").count().writeStream.format("memory").queryName("kiln_counts")
               .outputMode("complete").option("checkpointLocation", scratch_path(spark, "mem-ck"))
               .trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert spark.table("kiln_counts").agg(F.sum("count")).first()[0] == ev.count()
    q = (stream.select("event_id").writeStream.format("console").option("numRows", 2)
               .option("checkpointLocation", scratch_path(spark, "console-ck")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert not q.isActive
    per_batch = runner.run_batches(stream, "slice", lambda b, i: b.agg(F.count(F.lit(1)).alias("n")))
    assert runner.slice_batches(per_batch, 1, 2).count() == 2
    assert per_batch.agg(F.sum("n")).first()[0] == ev.count()
