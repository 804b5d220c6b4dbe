"""Sources, sinks, catalog and UDF surface.

Round trips write under the shared checkpoint folder (``scratch_path``)
and read back, so each query checks what the reader returns.
"""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.functions import random_columns as rnd
from kiln.plans.registry import query
from kiln.session import scratch_path
from kiln.sources.tables import fixed_length_records, parse_point, point_text, table, write_table

_LINES_SQL = """WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)"""


@query("s1_text_lines_round_trip", ids=("S1", "S9"), sql=_LINES_SQL + """
SELECT count(*) AS n_lines, sum(length(line)) AS n_chars, count(*) FILTER (WHERE line = '') AS n_empty FROM lines""")
def s1_text_lines_round_trip(spark, sf_dir):
    path = scratch_path(spark, "text")
    table(spark, sf_dir, "documents").select("text").write.mode("overwrite").option("compression", "gzip").text(path)
    lines = spark.read.text(path)
    return lines.agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("value")).cast("long").alias("n_chars"),
                     F.count_if(F.col("value") == "").alias("n_empty"))


@query("s1_generic_reader_schema_options", ids=("S1",), sql="""
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def s1_generic_reader_schema_options(spark, sf_dir):
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType()),
                           T.StructField("o_totalprice", T.DoubleType())])
    o = (spark.read.format("parquet").schema(schema).options(mergeSchema="false")
              .option("recursiveFileLookup", "false").load(f"{sf_dir}/orders.parquet"))
    return o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("s2_parquet_multi_path", ids=("S2",), sql="""
SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1""")
def s2_parquet_multi_path(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    a, b = scratch_path(spark, "pq-a"), scratch_path(spark, "pq-b")
    o.where("o_totalprice < 100000").write.parquet(a)
    o.where("o_totalprice >= 100000").write.parquet(b, mode="overwrite")
    back = spark.read.parquet(a, b)
    return back.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("s3_json_round_trip", ids=("S3",), sql="""
SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_total,
       round(sum(value), 2) AS value_total FROM events GROUP BY 1""")
def s3_json_round_trip(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    path = scratch_path(spark, "json")
    # to_json(struct) per row, stored as JSON lines, read back with inference
    ev.select(F.to_json(F.struct("event_id", "event_type", "value", "props")).alias("value")).write.text(path)
    back = spark.read.json(path)
    props = F.from_json("props", "k long")
    return back.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(props["k"]).alias("k_total"),
                                          F.round(F.sum("value"), 2).alias("value_total"))


@query("s3_json_given_schema_and_strings", ids=("S3",), sql="""
SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1""")
def s3_json_given_schema_and_strings(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("props")
    schema = F.schema_of_json(F.lit('{"k": 1}'))
    parsed = ev.select(F.from_json("props", schema).alias("p"))
    # also the JSON-lines reader over the same strings (written as text)
    path = scratch_path(spark, "json-strings")
    ev.select(F.col("props").alias("value")).write.text(path)
    via_reader = spark.read.schema("k long").json(path)
    a = parsed.groupBy(F.col("p.k").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    b = via_reader.groupBy("k").agg(F.count(F.lit(1)).alias("n2"))
    return a.join(b, "k").where(F.col("n") == F.col("n2")).select("k", "n")


@query("s4_orc_round_trip", ids=("S4",), sql="""
SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS bal FROM customer GROUP BY 1""")
def s4_orc_round_trip(spark, sf_dir):
    path = scratch_path(spark, "orc")
    table(spark, sf_dir, "customer").write.orc(path, mode="overwrite", partitionBy="c_mktsegment")
    back = spark.read.orc(path)
    return back.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("bal"))


@query("s5_save_modes_partition_pruning", ids=("S5",), sql="""
SELECT l_linestatus, 2 * count(*) AS n, round(2 * sum(l_quantity), 2) AS qty FROM lineitem
WHERE l_returnflag = 'R' GROUP BY 1""")
def s5_save_modes_partition_pruning(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    path = scratch_path(spark, "modes")
    write_table(li, path, mode="overwrite", partition_by=["l_returnflag"])
    write_table(li, path, mode="ignore", partition_by=["l_returnflag"])       # exists: no-op
    write_table(li, path, mode="append", partition_by=["l_returnflag"])       # doubles the rows
    try:
        write_table(li, path, mode="error", partition_by=["l_returnflag"])
        raise AssertionError("mode=error wrote over an existing path")
    except Exception as e:                                                    # noqa: BLE001
        if isinstance(e, AssertionError):
            raise
    back = spark.read.parquet(path).where(F.col("l_returnflag") == "R")      # partition filter
    return back.groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


@query("s7_temp_view_sql", ids=("S7",), sql="""
SELECT l_orderkey, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, CAST(o_orderdate AS DATE)::VARCHAR AS o_orderdate
FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
WHERE c_mktsegment = 'BUILDING' AND o_orderdate < TIMESTAMP '1995-03-15' AND l_shipdate > TIMESTAMP '1995-03-15'
GROUP BY l_orderkey, o_orderdate""")
def s7_temp_view_sql(spark, sf_dir):
    for n in ("customer", "orders", "lineitem"):
        table(spark, sf_dir, n).createOrReplaceTempView(n)
    return spark.sql("""
        SELECT l_orderkey, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue,
               CAST(CAST(o_orderdate AS DATE) AS STRING) AS o_orderdate
        FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
        WHERE c_mktsegment = 'BUILDING' AND o_orderdate < TIMESTAMP_NTZ '1995-03-15 00:00:00'
          AND l_shipdate > TIMESTAMP_NTZ '1995-03-15 00:00:00'
        GROUP BY l_orderkey, o_orderdate""")


@query("s10_range_missing_keys", ids=("S10",), sql="""
SELECT range AS id FROM range(0, (SELECT max(o_orderkey) + 1 FROM orders))
WHERE range NOT IN (SELECT o_orderkey FROM orders)""")
def s10_range_missing_keys(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    hi = o.agg(F.max("o_orderkey")).first()[0]
    ids = spark.range(0, hi + 1, 1, numPartitions=max(1, spark.sparkContext.defaultParallelism))
    return ids.join(o, ids.id == o.o_orderkey, "left_anti")


@query("s11_libsvm_round_trip", ids=("S11",), sql="""
WITH x AS (SELECT label, list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE))) AS s FROM embeddings)
SELECT CAST(label AS DOUBLE) AS label, count(*) AS n, round(sum(s), 4) AS total FROM x GROUP BY 1""")
def s11_libsvm_round_trip(spark, sf_dir):
    from pyspark.ml.functions import array_to_vector, vector_to_array
    e = table(spark, sf_dir, "embeddings")
    path = scratch_path(spark, "libsvm")
    data = e.select(F.col("label").cast("double").alias("label"),
                    array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    data.write.format("libsvm").save(path)
    back = spark.read.format("libsvm").option("numFeatures", 64).load(path)
    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, v: a + v)
    return back.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(total), 4).alias("total"))


@query("s11_labelled_point_text", ids=("S11",), sql="""
WITH x AS (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS j FROM embeddings)
SELECT CAST(label AS DOUBLE) AS label, CAST(j - 1 AS INTEGER) AS position, count(*) AS n, round(sum(CAST(v AS DOUBLE)), 4) AS total
FROM x GROUP BY 1, 2""")
def s11_labelled_point_text(spark, sf_dir):
    """Labelled points as text, ``(label,[v0,v1,...])``, written and parsed back."""
    e = table(spark, sf_dir, "embeddings")
    path = scratch_path(spark, "points")
    e.select(point_text(F.col("label").cast("double"), F.col("embedding").cast("array<double>"))).write.text(path)
    back = spark.read.text(path).select(*parse_point(F.col("value")))
    return (back.select("label", F.posexplode("vector").alias("position", "v")).groupBy("label", "position")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("v"), 4).alias("total")))


@query("s8_fixed_length_records", ids=("S8",), sql="""
SELECT o_orderkey FROM orders""")
def s8_fixed_length_records(spark, sf_dir):
    """Binary files of 12-byte records, cut into records on the executors."""
    o = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "records")
    o.select(F.lpad(F.col("o_orderkey").cast("string"), 11, " ")).write.text(path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
    return fixed_length_records(files, 12).select(F.trim(F.decode("record", "UTF-8").substr(1, 11)).cast("bigint").alias("o_orderkey"))


@query("s12_random_generators", ids=("S12",), sql="""
SELECT unnest(['uniform', 'normal', 'log_normal', 'exponential', 'poisson', 'gamma']) AS name, (SELECT count(*) FROM orders) AS n,
       true AS mean_in_bounds, true AS spread_in_bounds""")
def s12_random_generators(spark, sf_dir):
    """One draw of each distribution per order: mean and deviation lie near
    the distribution's."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    drawn = o.select(rnd.uniform(1).alias("uniform"), rnd.normal(2).alias("normal"), rnd.log_normal(0.0, 0.5, 3).alias("log_normal"),
                     rnd.exponential(2.0, 4).alias("exponential"), rnd.poisson(3.0, 5, "id").alias("poisson"),
                     rnd.gamma(2.0, 1.5, 6, "id").alias("gamma"))
    moments = {"uniform": (0.5, 12 ** -0.5), "normal": (0.0, 1.0), "log_normal": (1.1331, 0.6039), "exponential": (2.0, 2.0),
               "poisson": (3.0, 3 ** 0.5), "gamma": (3.0, 1.5 * 2 ** 0.5)}
    rows = drawn.select(F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).alias("v"), F.lit(m).alias("m"), F.lit(s).alias("s"))
                                            for c, (m, s) in moments.items()))).alias("x")).select("x.*")
    return rows.groupBy("name").agg(
        F.count("v").alias("n"), (F.abs(F.avg("v") - F.first("m")) < 6 * F.first("s") / F.sqrt(F.count("v"))).alias("mean_in_bounds"),
        F.stddev("v").between(F.first("s") * 0.75, F.first("s") * 1.3).alias("spread_in_bounds"))


@query("s12_random_vectors_and_linear_data", ids=("S12",), sql="""
SELECT count(*) AS n, true AS near_truth, true AS noise_in_bounds FROM orders""")
def s12_random_vectors_and_linear_data(spark, sf_dir):
    """Random vectors with y = w . x + b + noise: the residuals of the true
    weights are the noise."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    w, b, eps = [1.0, -2.0, 0.5], 3.0, 0.1
    d = rnd.linear_data(o, w, b, eps, seed=7)
    dot = sum((F.get("x", F.lit(i)) * v for i, v in enumerate(w)), F.lit(b))
    r = d.select((F.col("y") - dot).alias("r"))
    return r.agg(F.count("r").alias("n"), (F.abs(F.avg("r")) < 6 * eps / F.sqrt(F.count("r"))).alias("near_truth"),
                 F.stddev("r").between(0.8 * eps, 1.2 * eps).alias("noise_in_bounds"))


# ------------------------------------------------------------------ UDFs

@F.pandas_udf(T.LongType())
def _word_count_udf(text: pd.Series) -> pd.Series:
    return text.str.split(" ").str.len().astype("int64")


@query("x1_pandas_udf_and_sql_registration", ids=("X1",), sql="""
SELECT doc_id, CAST(len(string_split(text, ' ')) AS BIGINT) AS n_words,
       upper(lang) || ':' || source AS tag FROM documents""")
def x1_pandas_udf_and_sql_registration(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    spark.udf.register("kiln_tag", F.udf(lambda lang, src: None if lang is None or src is None else f"{lang.upper()}:{src}",
                                              T.StringType(), useArrow=True))
    docs.createOrReplaceTempView("documents")
    tagged = spark.sql("SELECT doc_id, kiln_tag(lang, source) AS tag FROM documents")
    counts = docs.select("doc_id", _word_count_udf("text").alias("n_words"))
    return counts.join(tagged, "doc_id")


@query("x2_map_in_pandas_and_arrow", ids=("X2", "F15"), sql="""
SELECT doc_id, CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS BIGINT) AS n_lines,
       CAST(n_chars AS BIGINT) AS n_chars FROM documents""")
def x2_map_in_pandas_and_arrow(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")

    def lines(batches):
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_lines": pdf["text"].str.count("\n") + 1,
                                "n_chars": pdf["n_chars"]})

    def passthrough(batches):
        for rb in batches:
            yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1), rb.column(2)],
                                             names=["doc_id", "n_lines", "n_chars"])

    a = docs.mapInPandas(lines, "doc_id long, n_lines long, n_chars long")
    return a.mapInArrow(passthrough, "doc_id long, n_lines long, n_chars long")
