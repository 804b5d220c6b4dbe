"""Structured Streaming queries.

Each query stages its input table as several files, runs a stream over
them to the end of input (``availableNow``), and returns the sink as a
batch table; its DuckDB twin is the batch answer over the same table.
Event time is ``events.ts`` (cast to TIMESTAMP under a UTC session so the
watermark accepts it, and back to TIMESTAMP_NTZ in the sink).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.operators.indexing import zip_with_index
from kiln.plans.registry import query
from kiln.session import partitions_for, scratch_path
from kiln.sources.tables import fixed_length_records, table
from kiln.streaming import models as smodels
from kiln.streaming import runner

N_BATCHES = 4


def _staged(spark, sf_dir, name, closing_s: int | None = None):
    """The events as a staged stream; ``closing_s``: with one last row of each
    type so many seconds after all others, which moves the watermark past
    every window (also below filters on the type or on a user being given)."""
    ev = table(spark, sf_dir, "events")
    last = None
    if closing_s is not None:
        late = F.max(F.max("ts")).over(Window.partitionBy()) + F.make_dt_interval(secs=F.lit(closing_s))
        last = ev.groupBy("event_type").agg(late.alias("ts")).withColumn("user_id", F.lit(-1))
        last = last.select(*(F.col(f.name).cast(f.dataType) if f.name in last.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in ev.schema))
    return runner.stage(ev, name, N_BATCHES, "event_id", last)


def _event_stream(spark, sf_dir, name):
    return _staged(spark, sf_dir, name).stream(spark)


def _watermarked(spark, sf_dir, name, delay: str, closing_s: int):
    """Events under a watermark, without the closing row.  The filter is on
    the event time, so it stays above the watermark's own bookkeeping."""
    end = table(spark, sf_dir, "events").agg(F.max("ts").cast("timestamp")).first()[0]
    s = _ts(_staged(spark, sf_dir, name, closing_s).stream(spark)).withWatermark("ts", delay)
    return s.where(F.col("ts") <= F.lit(end))


def _ts(stream: DataFrame) -> DataFrame:
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _fmt(c) -> F.Column:
    return F.date_format(F.col(c).cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss")


_CHUNK_SQL = "CAST(floor(event_id / ceil(((SELECT max(event_id) FROM events) + 1) / 4.0)) AS INTEGER)"


def _windows_sql(width_s: int, slide_s: int, extra: str = "") -> str:
    k = width_s // slide_s
    starts = ", ".join(f"s - {i * slide_s}" for i in range(k))
    return f"""WITH b AS (SELECT *, floor(epoch(ts) / {slide_s}) * {slide_s} AS s FROM events),
w AS (SELECT *, unnest([{starts}]) AS ws FROM b),
win AS (SELECT *, strftime(make_timestamp(CAST(ws * 1000000 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS window_start,
               strftime(make_timestamp(CAST((ws + {width_s}) * 1000000 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS window_end
        FROM w WHERE epoch(ts) >= ws AND epoch(ts) < ws + {width_s} {extra})"""


@query("t1_text_file_stream_word_count", ids=("T1", "T2"), sql="""
WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT word, count(*) AS n FROM (SELECT unnest(string_split(line, ' ')) AS word FROM lines) GROUP BY word""")
def t1_text_file_stream_word_count(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "docs-text")
    docs.select("text").repartition(max(N_BATCHES, partitions_for(docs, least=1))).write.text(path)
    lines = spark.readStream.text(path)
    words = lines.select(F.explode(F.split("value", " ", -1)).alias("word"))
    return runner.run_latest(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "t1", ["word"])


@query("t1_queue_stream", ids=("T1",), sql="""
SELECT 0 AS batch, count(*) AS n FROM region UNION ALL SELECT 1, count(*) FROM nation UNION ALL SELECT 2, count(*) FROM supplier""")
def t1_queue_stream(spark, sf_dir):
    """A queue of tables, one micro-batch each (``queueStream``)."""
    tables = [table(spark, sf_dir, "region").select(F.col("r_name").alias("name")),
              table(spark, sf_dir, "nation").select(F.col("n_name").alias("name")),
              table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"))]
    s = runner.queue_stream("t1-queue", tables)
    counts = runner.run_batches(s, "t1-queue", lambda b, _: b.agg(F.min("batch").alias("batch"), F.count(F.lit(1)).alias("n")))
    return counts.drop("batch_id")


@query("t1_fixed_length_record_stream", ids=("T1", "S8"), sql="""
SELECT event_id, count(*) AS n FROM events GROUP BY 1""")
def t1_fixed_length_record_stream(spark, sf_dir):
    """Binary files of 16-byte records, read as a stream and cut into records
    (``binaryRecordsStream``): the event id in fixed width."""
    ev = table(spark, sf_dir, "events")
    path = scratch_path(spark, "records")
    ev.select(F.lpad(F.col("event_id").cast("string"), 15, " ")).repartition(max(N_BATCHES, partitions_for(ev, least=1))).write.text(path)
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary") \
        .option("pathGlobFilter", "*.txt").load(path)
    ids = fixed_length_records(files, 16).select(F.trim(F.decode("record", "UTF-8").substr(1, 15)).cast("bigint").alias("event_id"))
    return runner.run_latest(ids.groupBy("event_id").agg(F.count(F.lit(1)).alias("n")), "t1-records", ["event_id"])


@query("t2_stateless_transforms", ids=("T2",), sql="""
SELECT event_id, upper(event_type) AS kind, value * 2 AS double_value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM events WHERE event_type IN ('click', 'view')""")
def t2_stateless_transforms(spark, sf_dir):
    s = _event_stream(spark, sf_dir, "t2")
    out = (s.where(F.col("event_type").isin("click", "view"))
            .select("event_id", F.upper("event_type").alias("kind"), (F.col("value") * 2).alias("double_value"),
                    F.get_json_object("props", "$.k").cast("long").alias("k")))
    return runner.run_append(out, "t2")


@query("t3_stream_static_join", ids=("T3", "T11"), sql="""
SELECT event_id, c_mktsegment, round(value, 2) AS value FROM events JOIN customer ON user_id = c_custkey""")
def t3_stream_static_join(spark, sf_dir):
    s = _event_stream(spark, sf_dir, "t3")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    j = s.join(cust, s.user_id == cust.c_custkey)
    return runner.run_append(j.select("event_id", "c_mktsegment", F.round("value", 2).alias("value")), "t3")


@query("t4_per_batch_aggregates", ids=("T4", "T13"), sql=f"""
SELECT {_CHUNK_SQL} AS chunk, count(*) AS n, round(sum(value), 2) AS total, round(max(value), 2) AS max_value
FROM events GROUP BY 1""")
def t4_per_batch_aggregates(spark, sf_dir):
    s = _event_stream(spark, sf_dir, "t4")

    def per_batch(batch: DataFrame, batch_id: int) -> DataFrame:
        return batch.agg(F.min("chunk").alias("chunk"), F.count(F.lit(1)).alias("n"),
                         F.round(F.sum("value"), 2).alias("total"), F.round(F.max("value"), 2).alias("max_value"))

    return runner.run_batches(s, "t4", per_batch).drop("batch_id")


@query("t5_count_by_value_per_batch", ids=("T5",), sql=f"""
SELECT {_CHUNK_SQL} AS chunk, count(DISTINCT event_type) AS n_distinct, count(*) AS n FROM events GROUP BY 1""")
def t5_count_by_value_per_batch(spark, sf_dir):
    """The reference's countByValue ends in count(): distinct values per batch."""
    s = _event_stream(spark, sf_dir, "t5")

    def per_batch(batch: DataFrame, batch_id: int) -> DataFrame:
        return batch.agg(F.min("chunk").alias("chunk"), F.count_distinct("event_type").alias("n_distinct"),
                         F.count(F.lit(1)).alias("n"))

    return runner.run_batches(s, "t5", per_batch).drop("batch_id")


@query("t6_sliding_event_time_window", ids=("T6",), sql=_windows_sql(3600, 1800) + """
SELECT window_start, window_end, count(*) AS n FROM win GROUP BY 1, 2""")
def t6_sliding_event_time_window(spark, sf_dir):
    with runner.utc_session(spark):
        s = _watermarked(spark, sf_dir, "t6", "1 hour", 3 * 3600)
        agg = s.groupBy(F.window("ts", "1 hour", "30 minutes").alias("w")).agg(F.count(F.lit(1)).alias("n"))
        agg = agg.select(_fmt("w.start").alias("window_start"), _fmt("w.end").alias("window_end"), "n")
        return runner.run_append(agg, "t6")


@query("t7_count_and_reduce_by_window", ids=("T7",), sql=_windows_sql(7200, 3600) + """
SELECT window_start, count(*) AS n, round(sum(value), 2) AS total FROM win GROUP BY 1""")
def t7_count_and_reduce_by_window(spark, sf_dir):
    with runner.utc_session(spark):
        s = _watermarked(spark, sf_dir, "t7", "2 hours", 5 * 3600)
        agg = s.groupBy(F.window("ts", "2 hours", "1 hour").alias("w")).agg(
            F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))
        return runner.run_append(agg.select(_fmt("w.start").alias("window_start"), "n", "total"), "t7")


@query("t8_keyed_window_reduce_filter", ids=("T8",), sql=_windows_sql(86400, 43200) + """
SELECT window_start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM win
GROUP BY 1, 2 HAVING sum(value) > 300""")
def t8_keyed_window_reduce_filter(spark, sf_dir):
    with runner.utc_session(spark):
        s = _watermarked(spark, sf_dir, "t8", "1 day", 3 * 86400)
        agg = s.groupBy(F.window("ts", "1 day", "12 hours").alias("w"), "event_type").agg(
            F.count(F.lit(1)).alias("n"), F.sum("value").alias("_total"))
        agg = agg.where(F.col("_total") > 300)      # filterFunc: drop keys below the threshold
        agg = agg.select(_fmt("w.start").alias("window_start"), "event_type", "n",
                         F.round("_total", 2).alias("total"))
        return runner.run_append(agg, "t8")


@query("t9_distinct_values_by_window", ids=("T9",), sql=_windows_sql(86400, 86400) + """
SELECT window_start, count(DISTINCT user_id) AS n_users FROM win GROUP BY 1""")
def t9_distinct_values_by_window(spark, sf_dir):
    with runner.utc_session(spark):
        s = _watermarked(spark, sf_dir, "t9", "1 day", 3 * 86400)
        per_value = s.groupBy(F.window("ts", "1 day").alias("w"), "user_id").agg(F.count(F.lit(1)).alias("c"))
        seen = runner.run_append(per_value.select(_fmt("w.start").alias("window_start"), "user_id"), "t9")
    return seen.groupBy("window_start").agg(F.count(F.lit(1)).alias("n_users"))


@query("t10_update_state_by_key", ids=("T10",), sql="""
SELECT user_id, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1""")
def t10_update_state_by_key(spark, sf_dir):
    """Sums and counts need no custom state: an aggregate in update mode."""
    s = _event_stream(spark, sf_dir, "t10").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return runner.run_latest(s, "t10", ["user_id"]).withColumn("total", F.round("total", 4))


@query("t10_update_state_removing_keys", ids=("T10",), sql=f"""
WITH c AS (SELECT user_id, {_CHUNK_SQL} AS chunk, count(*) AS n FROM events GROUP BY 1, 2),
g AS (SELECT u.user_id, k.chunk, coalesce(c.n, 0) AS n FROM (SELECT DISTINCT user_id FROM events) u
      CROSS JOIN (SELECT DISTINCT chunk FROM c) k LEFT JOIN c ON c.user_id = u.user_id AND c.chunk = k.chunk),
m AS (SELECT user_id, coalesce(max(chunk) FILTER (WHERE n = 0), -1) AS missed FROM g GROUP BY 1)
SELECT user_id, sum(n)::BIGINT AS n, count(*) AS batches FROM g JOIN m USING (user_id) WHERE chunk > missed GROUP BY 1""")
def t10_update_state_removing_keys(spark, sf_dir):
    """The state function sees every key after each batch, and a key without
    new rows is removed: what is left are runs of batches up to the last."""
    s = _event_stream(spark, sf_dir, "t10b")
    new = {"fresh": F.count(F.lit(1))}
    state = {"n": F.when(F.col("fresh").isNotNull(), F.coalesce("n", F.lit(0)) + F.col("fresh")),
             "batches": F.coalesce("batches", F.lit(0)) + 1}
    return runner.update_state_by_key(s, "t10b", "user_id", new, state, F.col("n").isNotNull(), "user_id bigint, n bigint, batches bigint")


_JOIN_SQL = """
WITH c AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click'),
p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase')
SELECT c.event_id AS click_id, p.event_id AS purchase_id FROM c {how} JOIN p
  ON c.user_id = p.user_id AND p.ts >= c.ts AND p.ts <= c.ts + INTERVAL 6 HOUR"""


def _interval_join(spark, sf_dir, name, how):
    """Clicks and the same user's purchases within six hours.  Rows without a
    match come out once the watermark has passed their interval."""
    with runner.utc_session(spark):
        staged = _staged(spark, sf_dir, name, 3 * 86400)
        end = table(spark, sf_dir, "events").agg(F.max("ts").cast("timestamp")).first()[0]

        def side(kind, prefix):
            s = _ts(staged.stream(spark)).select(F.col("event_id").alias(f"{kind}_id"), F.col("user_id").alias(f"{prefix}_user"),
                                                 F.col("event_type").alias(f"{prefix}_type"), F.col("ts").alias(f"{prefix}_ts"))
            s = s.withWatermark(f"{prefix}_ts", "12 hours")
            # the filter on the event time stays above the watermark, so the closing row is counted there
            return s.where((F.col(f"{prefix}_ts") <= F.lit(end)) & (F.col(f"{prefix}_type") == kind)).drop(f"{prefix}_type")

        cond = ((F.col("c_user") == F.col("p_user")) & (F.col("p_ts") >= F.col("c_ts"))
                & (F.col("p_ts") <= F.col("c_ts") + F.expr("INTERVAL 6 HOURS")))
        j = side("click", "c").join(side("purchase", "p"), cond, how)
        return runner.run_append(j.select("click_id", "purchase_id"), name)


@query("t11_stream_stream_interval_join", ids=("T11",), sql=_JOIN_SQL.format(how=""))
def t11_stream_stream_interval_join(spark, sf_dir):
    return _interval_join(spark, sf_dir, "t11", "inner")


@query("t11_stream_stream_left_join", ids=("T11",), sql=_JOIN_SQL.format(how="LEFT"))
def t11_stream_stream_left_join(spark, sf_dir):
    return _interval_join(spark, sf_dir, "t11l", "left_outer")


@query("t11_stream_stream_right_join", ids=("T11",), sql=_JOIN_SQL.format(how="RIGHT"))
def t11_stream_stream_right_join(spark, sf_dir):
    return _interval_join(spark, sf_dir, "t11r", "right_outer")


@query("t11_stream_stream_full_join", ids=("T11",), sql=_JOIN_SQL.format(how="FULL"))
def t11_stream_stream_full_join(spark, sf_dir):
    return _interval_join(spark, sf_dir, "t11f", "full_outer")


def _two_streams(spark, sf_dir, name):
    """Clicks and purchases as one stream of both, tagged by side; a batch
    holds the same part of either."""
    staged = _staged(spark, sf_dir, name)
    a = staged.stream(spark).where("event_type = 'click'").withColumn("side", F.lit("click"))
    b = staged.stream(spark).where("event_type = 'purchase'").withColumn("side", F.lit("purchase"))
    return a.unionByName(b)


@query("t3_two_stream_transform", ids=("T3",), sql=f"""
WITH e AS (SELECT *, {_CHUNK_SQL} AS chunk FROM events)
SELECT event_id FROM e WHERE event_type = 'click' AND NOT EXISTS (
  SELECT 1 FROM e p WHERE p.event_type = 'purchase' AND p.chunk = e.chunk AND p.user_id = e.user_id)""")
def t3_two_stream_transform(spark, sf_dir):
    """A function of both streams' batches (``transformWith``): clicks of
    users without a purchase in the same batch."""
    def both(batch: DataFrame, _: int) -> DataFrame:
        clicks, buys = (batch.where(F.col("side") == side) for side in ("click", "purchase"))
        return clicks.join(buys, "user_id", "left_anti").select("event_id")

    return runner.run_batches(_two_streams(spark, sf_dir, "t3b"), "t3b", both).drop("batch_id")


@query("t11_cogroup_per_batch", ids=("T11",), sql=f"""
SELECT {_CHUNK_SQL} AS chunk, user_id, count(*) FILTER (WHERE event_type = 'click') AS n_clicks,
       count(*) FILTER (WHERE event_type = 'purchase') AS n_purchases
FROM events WHERE event_type IN ('click', 'purchase') GROUP BY 1, 2""")
def t11_cogroup_per_batch(spark, sf_dir):
    def cogroup(batch: DataFrame, _: int) -> DataFrame:
        return batch.groupBy("chunk", "user_id").agg(F.count_if(F.col("side") == "click").alias("n_clicks"),
                                                     F.count_if(F.col("side") == "purchase").alias("n_purchases"))

    return runner.run_batches(_two_streams(spark, sf_dir, "t11c"), "t11c", cogroup).drop("batch_id")


@query("t12_union_streams", ids=("T12",), sql="""
SELECT event_type, count(*) AS n FROM events GROUP BY 1""")
def t12_union_streams(spark, sf_dir):
    a = _event_stream(spark, sf_dir, "t12a").where("event_type = 'click'")
    b = _event_stream(spark, sf_dir, "t12b").where("event_type <> 'click' or event_type is null")
    u = a.select("event_type").union(b.select("event_type"))
    return runner.run_latest(u.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")), "t12", ["event_type"])


@query("t13_text_folder_per_batch", ids=("T13",), sql=f"""
SELECT {_CHUNK_SQL} AS chunk, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def t13_text_folder_per_batch(spark, sf_dir):
    """Every batch is written as a text folder, and the folders are read back."""
    s = _event_stream(spark, sf_dir, "t13")
    out = runner.run_text_folders(s.select(F.concat_ws(",", "chunk", "event_type").alias("value")), "t13")
    parts = F.split("value", ",")
    return (spark.read.option("basePath", out).text(out).select(parts[0].cast("int").alias("chunk"), parts[1].alias("event_type"))
            .groupBy("chunk", "event_type").agg(F.count(F.lit(1)).alias("n")))


@query("t16_repartition_each_batch", ids=("T16",), sql=f"""
SELECT {_CHUNK_SQL} AS chunk, count(*) AS n, true AS at_most_three FROM events GROUP BY 1""")
def t16_repartition_each_batch(spark, sf_dir):
    s = _event_stream(spark, sf_dir, "t16")

    def per_batch(batch: DataFrame, batch_id: int) -> DataFrame:
        r = batch.repartition(3, "user_id")
        parts = r.groupBy(F.spark_partition_id().alias("pid")).agg(F.min("chunk").alias("chunk"), F.count(F.lit(1)).alias("n"))
        return parts.agg(F.min("chunk").alias("chunk"), F.sum("n").alias("n"), (F.count(F.lit(1)) <= 3).alias("at_most_three"))

    return runner.run_batches(s, "t16", per_batch).drop("batch_id")


@query("t17_streaming_kmeans", ids=("T17",))
def t17_streaming_kmeans(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    stream = runner.stage(e, "t17", N_BATCHES, "vec_id").stream(spark)
    return smodels.streaming_kmeans(stream, "embedding", k=4, decay=0.9, seed=1, name="t17")


@query("t17_kmeans_predict", ids=("T17",), sql="""
SELECT count(*) AS n, true AS all_assigned, true AS nearest FROM embeddings""")
def t17_kmeans_predict(spark, sf_dir):
    """Clusters of all vectors by the last model, decayed per point."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    staged = runner.stage(e, "t17p", N_BATCHES, "vec_id")
    history = smodels.streaming_kmeans(staged.stream(spark), "embedding", k=4, decay=0.999, time_unit="points", seed=1, name="t17p")
    centres = smodels.last_centres(history)
    p = smodels.assign_clusters(e, "embedding", centres)
    x = F.col("embedding").cast("array<double>")
    d = F.array(*(smodels._sqdist(x, c) for c in centres))
    return p.agg(F.count(F.lit(1)).alias("n"), F.every(F.col("cluster").between(0, 3)).alias("all_assigned"),
                 F.every(F.get(d, F.col("cluster")) <= F.array_min(d)).alias("nearest"))


def _regression_stream(spark, sf_dir, name):
    li = zip_with_index(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey"], "rid").select(
        "rid", F.array((F.col("l_quantity") / 50).cast("double"), F.col("l_discount").cast("double"),
                       F.col("l_tax").cast("double")).alias("x"),
        (F.col("l_extendedprice") / 100000).alias("y"), (F.col("l_quantity") > 25).cast("double").alias("large"))
    return li, runner.stage(li, name, N_BATCHES, "rid").stream(spark)


@query("t18_streaming_linear_regression", ids=("T18",))
def t18_streaming_linear_regression(spark, sf_dir):
    _, stream = _regression_stream(spark, sf_dir, "t18")
    return smodels.streaming_linear_sgd(stream, "x", "y", n_features=3, step=0.1, iters_per_batch=5, name="t18")


@query("t18_streaming_logistic_predict", ids=("T18",), sql="""
SELECT count(*) AS n, true AS probabilities, true AS learned FROM lineitem""")
def t18_streaming_logistic_predict(spark, sf_dir):
    """Logistic model over the stream; predictions of all rows: the label is
    a threshold of the first feature, so large ones get larger probabilities."""
    li, stream = _regression_stream(spark, sf_dir, "t18l")
    centred = F.transform("x", lambda v: v - 0.5)
    history = smodels.streaming_linear_sgd(stream.withColumn("x", centred), "x", "large", n_features=3, step=2.0, iters_per_batch=5,
                                           name="t18l", logistic=True)
    p = smodels.predict_linear(li.withColumn("x", centred), "x", smodels.last_weights(history), logistic=True)
    return p.agg(F.count(F.lit(1)).alias("n"), F.every(F.col("prediction").between(0, 1)).alias("probabilities"),
                 (F.avg(F.when(F.col("large") == 1, F.col("prediction"))) > F.avg(F.when(F.col("large") == 0, F.col("prediction"))) + 0.05).alias("learned"))
