"""Household-power regression pipeline.

The test tables carry no power records, so two sources stand in:
* ``events`` rendered as ';'-separated power records (with header copies,
  short records and unparsable fields) for the parser, and
* ``lineitem`` joined to ``part`` as the regression data set: 7 inputs,
  1 target, bucket = orderkey mod 10 + 1, 5 contiguous folds per bucket
  ordered by the full lineitem row (unique; orderkey+linenumber is not).
With fixed weights the whole nested-CV evaluation is plain SQL, so every
stage has a DuckDB twin.  Training (P9-P14, P19) lives in fit_plans.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.operators import cv, joins, power
from kiln.operators.layers import init_weights, layer_sizes
from kiln.plans.registry import query
from kiln.session import bounded_local, materialize
from kiln.sources.tables import table

K = 5
N_BUCKETS = 10
INPUTS = ["x1", "x2", "x3", "x4", "x5", "x6", "x7"]
TARGET = "t"
SIZES = layer_sizes(7, [2], 1)
# Deterministic stand-in weights for the un-trained evaluation (7-[2]-1).
FIXED_W = np.round(init_weights(SIZES, np.random.default_rng(7)), 6)
LINEITEM_ORDER = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                  "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                  "l_shipdate"]
# Header line of the household power file.
POWER_HEADER = ("Date;Time;Global_active_power;Global_reactive_power;Voltage;"
                "Global_intensity;Sub_metering_1;Sub_metering_2;Sub_metering_3")


# --------------------------------------------------------------------------
# sources
# --------------------------------------------------------------------------

def events_power_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as power records: every 97th a header copy, every 50th
    short (3 fields), every 7th with an unparsable sub-metering field."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    full = F.concat_ws(
        ";", F.date_format("ts", "d/M/yyyy"), F.date_format("ts", "HH:mm:ss"),
        F.col("value").cast("string"), F.col("user_id").cast("string"),
        F.get_json_object("props", "$.k"), F.pmod(eid, F.lit(17)).cast("string"),
        F.col("event_type"), F.hour("ts").cast("string"),
        F.when(F.pmod(eid, F.lit(7)) == 0, F.lit("?")).otherwise(F.minute("ts").cast("string")))
    short = F.concat_ws(";", F.date_format("ts", "d/M/yyyy"), F.date_format("ts", "HH:mm:ss"),
                        F.col("value").cast("string"))
    line = (F.when(F.pmod(eid, F.lit(97)) == 0, F.lit(POWER_HEADER))
             .when(F.pmod(eid, F.lit(50)) == 0, short).otherwise(full))
    return ev.select("event_id", line.alias("value"))


_EVENT_LINES_SQL = f"""
lines AS (
  SELECT event_id,
    CASE WHEN event_id % 97 = 0 THEN '{POWER_HEADER}'
         WHEN event_id % 50 = 0 THEN concat_ws(';', strftime(ts, '%-d/%-m/%Y'), strftime(ts, '%H:%M:%S'),
              CAST(value AS VARCHAR))
         ELSE concat_ws(';', strftime(ts, '%-d/%-m/%Y'), strftime(ts, '%H:%M:%S'), CAST(value AS VARCHAR),
              CAST(user_id AS VARCHAR), json_extract_string(props, '$.k'), CAST(event_id % 17 AS VARCHAR),
              event_type, CAST(hour(ts) AS VARCHAR),
              CASE WHEN event_id % 7 = 0 THEN '?' ELSE CAST(minute(ts) AS VARCHAR) END)
    END AS value
  FROM events),
kept AS (SELECT * FROM lines WHERE value <> (SELECT value FROM lines ORDER BY event_id LIMIT 1))"""

_PARSED_SQL = _EVENT_LINES_SQL + """,
sp AS (SELECT event_id, string_split(value, ';') AS p FROM kept),
parsed AS (
  SELECT event_id,
    CASE WHEN len(p) >= 9 THEN CAST(coalesce(TRY_CAST(string_split(p[2], ':')[1] AS INTEGER) * 60
         + TRY_CAST(string_split(p[2], ':')[2] AS INTEGER), 0) AS DOUBLE) ELSE -1.0 END AS time,
    CASE WHEN len(p) >= 9 THEN coalesce(TRY_CAST(p[4] AS DOUBLE), 0.0) ELSE 0.0 END AS global_reactive_power,
    CASE WHEN len(p) >= 9 THEN coalesce(TRY_CAST(p[5] AS DOUBLE), 0.0) ELSE 0.0 END AS voltage,
    CASE WHEN len(p) >= 9 THEN coalesce(TRY_CAST(p[6] AS DOUBLE), 0.0) ELSE 0.0 END AS global_intensity,
    CASE WHEN len(p) >= 9 THEN coalesce(TRY_CAST(p[7] AS DOUBLE), 0.0) ELSE 0.0 END AS sub_metering_1,
    CASE WHEN len(p) >= 9 THEN coalesce(TRY_CAST(p[8] AS DOUBLE), 0.0) ELSE 0.0 END AS sub_metering_2,
    CASE WHEN len(p) >= 9 THEN coalesce(TRY_CAST(p[9] AS DOUBLE), 0.0) ELSE 0.0 END AS sub_metering_3,
    CASE WHEN len(p) >= 9 THEN coalesce(TRY_CAST(p[3] AS DOUBLE), 0.0) ELSE 0.0 END AS target,
    len(p) < 9 AS is_bad
  FROM sp)"""


def parsed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = power.drop_header(events_power_lines(spark, sf_dir), order_by="event_id")
    return power.parse_records(lines, keep=["event_id"])


@query("p1_drop_header_lines", ids=("P1",), sql="WITH " + _EVENT_LINES_SQL + """
SELECT event_id, CAST(len(string_split(value, ';')) AS INTEGER) AS n_fields FROM kept""")
def p1_drop_header_lines(spark, sf_dir):
    lines = power.drop_header(events_power_lines(spark, sf_dir), order_by="event_id")
    return lines.select("event_id", F.size(F.split("value", ";", -1)).alias("n_fields"))


@query("p2_parse_records", ids=("P2",), sql="WITH " + _PARSED_SQL + " SELECT * FROM parsed")
def p2_parse_records(spark, sf_dir):
    return parsed_events(spark, sf_dir)


@query("p3_bad_record_counts", ids=("P3",), sql="WITH " + _PARSED_SQL + """
SELECT count(*) FILTER (WHERE NOT is_bad AND time <> -1) AS n_good,
       count(*) FILTER (WHERE is_bad) AS n_bad FROM parsed""")
def p3_bad_record_counts(spark, sf_dir):
    p = parsed_events(spark, sf_dir)
    return p.agg(F.count_if(~F.col("is_bad") & (F.col("time") != -1)).alias("n_good"),
                 F.count_if("is_bad").alias("n_bad"))


@query("p4_bucket_sizes", ids=("P4",), sql="WITH " + _PARSED_SQL + """
SELECT CAST(event_id % 10 + 1 AS INTEGER) AS bucket, count(*) AS n_rows
FROM parsed WHERE NOT is_bad GROUP BY 1""")
def p4_bucket_sizes(spark, sf_dir):
    p = power.good_rows(parsed_events(spark, sf_dir))
    b = power.assign_bucket(p, ["event_id"], N_BUCKETS, method="mod")
    return b.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_rows"))


@query("p5_bucket_totals", ids=("P5",), sql="WITH " + _PARSED_SQL + """
SELECT CAST(event_id % 10 + 1 AS INTEGER) AS bucket, count(*) AS n_rows,
       round(sum(target), 4) AS sum_target, round(avg(voltage), 6) AS avg_voltage
FROM parsed WHERE NOT is_bad GROUP BY 1""")
def p5_bucket_totals(spark, sf_dir):
    p = power.good_rows(parsed_events(spark, sf_dir))
    b = power.assign_bucket(p, ["event_id"], N_BUCKETS, method="mod")
    return b.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_rows"),
                                   F.round(F.sum("target"), 4).alias("sum_target"),
                                   F.round(F.avg("voltage"), 6).alias("avg_voltage"))


# --------------------------------------------------------------------------
# regression data set on lineitem x part
# --------------------------------------------------------------------------

# Fold-assigned rows already written by this application, keyed by the input
# files' names and times.
_ROWS: dict = {}


def _version(df: DataFrame) -> tuple:
    """Application, and a hash over a table's files and when they were written."""
    mark = F.xxhash64("_metadata.file_path", "_metadata.file_modification_time").cast("decimal(38,0)")
    return df.sparkSession.sparkContext.applicationId, df.agg(F.sum(mark)).first()[0]


def regression_rows(spark: SparkSession, sf_dir: str, keep_index: bool = False) -> DataFrame:
    """lineitem x part -> key, bucket, x1..x7, t, fold (contiguous, k=5)."""
    li = table(spark, sf_dir, "lineitem")
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    key = (keep_index, _version(table(spark, sf_dir, "lineitem")), _version(table(spark, sf_dir, "part")))
    if key not in _ROWS:
        _ROWS[key] = _regression_rows(li, pa, keep_index)
    return _ROWS[key]


def _regression_rows(li: DataFrame, pa: DataFrame, keep_index: bool) -> DataFrame:
    # too many parts to send: a shuffle by part whose larger side isn't sorted, so that it spills nothing
    parts = F.broadcast(pa) if joins.measured_bytes(pa) <= joins.BROADCAST_BYTES else pa.hint("shuffle_hash")
    j = li.join(parts, li.l_partkey == pa.p_partkey)
    # written once: the range shuffle of the folds reads its input twice
    rows = materialize(power.assign_bucket(j.select(*LINEITEM_ORDER, "p_size", "p_retailprice"), ["l_orderkey"], N_BUCKETS, method="mod"),
                       "regression", "zstd")
    # lineage after this: Parquet scan of the tagged rows + broadcast spans;
    # the inputs, all but copies of table columns, are computed as it is read
    tagged = power.assign_folds(rows, K, LINEITEM_ORDER, keep_index=keep_index,
                                keep_cols=["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice",
                                           "l_shipdate", "l_extendedprice"])
    return tagged.select(
        "bucket", "l_orderkey", "l_linenumber",
        F.col("l_quantity").cast("double").alias("x1"), F.col("l_discount").alias("x2"),
        F.col("l_tax").alias("x3"), F.col("p_size").cast("double").alias("x4"),
        F.col("p_retailprice").alias("x5"), F.col("l_linenumber").cast("double").alias("x6"),
        F.dayofyear("l_shipdate").cast("double").alias("x7"), F.col("l_extendedprice").alias("t"),
        *(["idx"] if keep_index else []), "n_in_group", "fold")


_MODELS: dict = {}


def fixed_models(rows: DataFrame) -> DataFrame:
    """Per-model standardisation (buckets x k x (k-1) rows, a parameter
    bound), kept as a local relation so scoring plans do not recompute it."""
    key = (rows.sparkSession.sparkContext.applicationId, rows.semanticHash())
    if key not in _MODELS:
        _MODELS[key] = _fixed_models(rows)
    return _MODELS[key]


def _fixed_models(rows: DataFrame) -> DataFrame:
    plan = cv.cv_plan(rows.select("bucket"), K)
    moments = cv.fold_moments(rows, [*INPUTS, TARGET])
    std = cv.model_standardization(moments, plan, [*INPUTS, TARGET])
    return bounded_local(cv.standardization_arrays(std, INPUTS, TARGET), N_BUCKETS * K * (K - 1))


_ORDER_SQL = ", ".join(LINEITEM_ORDER)
_ROWS_SQL = f"""
rows0 AS (
  SELECT {_ORDER_SQL},
    CAST(l_quantity AS DOUBLE) AS x1, l_discount AS x2, l_tax AS x3, CAST(p_size AS DOUBLE) AS x4,
    p_retailprice AS x5, CAST(l_linenumber AS DOUBLE) AS x6, CAST(dayofyear(l_shipdate) AS DOUBLE) AS x7,
    l_extendedprice AS t, CAST(l_orderkey % 10 + 1 AS INTEGER) AS bucket
  FROM lineitem JOIN part ON l_partkey = p_partkey),
rows1 AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY {_ORDER_SQL}) - 1 AS idx,
                 count(*) OVER (PARTITION BY bucket) AS n_in_group FROM rows0),
rows AS (SELECT *, CAST(least(floor(idx / floor(n_in_group / {K})), {K - 1}) AS INTEGER) AS fold FROM rows1),
plan AS (SELECT b.bucket, CAST(tf.f AS INTEGER) AS test_fold, CAST(vf.f AS INTEGER) AS val_fold
         FROM (SELECT DISTINCT bucket FROM rows) b, range({K}) tf(f), range({K}) vf(f) WHERE tf.f <> vf.f),
models AS (
  SELECT p.bucket, p.test_fold, p.val_fold, count(*) AS n_train,
    {", ".join(f"avg(r.{c}) AS {c}_mean, stddev_pop(r.{c}) AS {c}_std" for c in [*INPUTS, TARGET])}
  FROM plan p JOIN rows r ON r.bucket = p.bucket AND r.fold <> p.test_fold AND r.fold <> p.val_fold
  GROUP BY p.bucket, p.test_fold, p.val_fold)"""


def _forward_sql(xs: list[str], w: np.ndarray, sizes: list[int]) -> str:
    off, z = 0, xs
    for li in range(len(sizes) - 1):
        r, c = sizes[li] + 1, sizes[li + 1]
        outs = []
        for j in range(c):
            terms = [repr(float(w[off + j]))]
            terms += [f"({zi}) * {float(w[off + (i + 1) * c + j])!r}" for i, zi in enumerate(z)]
            s = " + ".join(terms)
            outs.append(f"tanh({s})" if li < len(sizes) - 2 else f"({s})")
        z = outs
        off += r * c
    return z[0]


def _predict_sql(r: str = "r", m: str = "m") -> str:
    xs = [f"CASE WHEN {m}.{c}_std = 0 THEN 0.0 ELSE ({r}.{c} - {m}.{c}_mean) / {m}.{c}_std END" for c in INPUTS]
    return f"(({_forward_sql(xs, FIXED_W, SIZES)}) * {m}.t_std + {m}.t_mean)"


_VAL_ERR_SQL = _ROWS_SQL + f""",
val_err AS (
  SELECT m.bucket, m.test_fold, m.val_fold, count(*) AS n_scored,
         sqrt(avg(power({_predict_sql()} - r.t, 2))) AS rmse
  FROM rows r JOIN models m ON r.bucket = m.bucket AND r.fold = m.val_fold
  GROUP BY m.bucket, m.test_fold, m.val_fold)"""


def _report_sql(mode: str) -> str:
    if mode == "per_fold":
        best = """best AS (
  SELECT bucket, test_fold, test_fold AS model_test_fold, val_fold AS model_val_fold, rmse AS min_val_rmse
  FROM (SELECT *, row_number() OVER (PARTITION BY bucket, test_fold ORDER BY rmse, val_fold) AS rk FROM val_err)
  WHERE rk = 1)"""
    else:
        best = """ordered AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY test_fold, val_fold) AS pos FROM val_err),
runmin AS (
  SELECT a.bucket, a.test_fold, a.val_fold, a.pos,
         arg_min(b.test_fold, (b.rmse, b.test_fold, b.val_fold)) AS model_test_fold,
         arg_min(b.val_fold, (b.rmse, b.test_fold, b.val_fold)) AS model_val_fold,
         min(b.rmse) AS min_val_rmse
  FROM ordered a JOIN ordered b ON a.bucket = b.bucket AND b.pos <= a.pos
  GROUP BY a.bucket, a.test_fold, a.val_fold, a.pos),
best AS (
  SELECT bucket, test_fold, model_test_fold, model_val_fold, min_val_rmse
  FROM (SELECT *, row_number() OVER (PARTITION BY bucket, test_fold ORDER BY val_fold DESC) AS rk FROM runmin)
  WHERE rk = 1)"""
    return "WITH " + _VAL_ERR_SQL + ",\n" + best + f""",
test_err AS (
  SELECT bst.bucket, bst.test_fold, sqrt(avg(power({_predict_sql()} - r.t, 2))) AS test_rmse
  FROM best bst
  JOIN models m ON m.bucket = bst.bucket AND m.test_fold = bst.model_test_fold AND m.val_fold = bst.model_val_fold
  JOIN rows r ON r.bucket = bst.bucket AND r.fold = bst.test_fold
  GROUP BY bst.bucket, bst.test_fold),
ns AS (SELECT bucket, count(*) AS n_samples FROM rows GROUP BY bucket)
SELECT b.bucket, CAST(b.test_fold AS INTEGER) AS test_fold, ns.n_samples,
       CAST(b.model_test_fold AS INTEGER) AS model_test_fold, CAST(b.model_val_fold AS INTEGER) AS model_val_fold,
       round(b.min_val_rmse, 3) AS min_val_rmse, round(te.test_rmse, 3) AS test_rmse
FROM best b JOIN test_err te USING (bucket, test_fold) JOIN ns USING (bucket)"""


@query("p6_contiguous_folds", ids=("P6",), sql="WITH " + _ROWS_SQL + """
SELECT bucket, fold, count(*) AS n_rows, min(idx) AS first_idx, max(idx) AS last_idx FROM rows GROUP BY 1, 2""")
def p6_contiguous_folds(spark, sf_dir):
    li = regression_rows(spark, sf_dir, keep_index=True)
    return li.groupBy("bucket", "fold").agg(F.count(F.lit(1)).alias("n_rows"),
                                            F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"))


@query("p7_cv_plan", ids=("P7",), sql="WITH " + _ROWS_SQL + """,
fc AS (SELECT bucket, fold, count(*) AS n FROM rows GROUP BY 1, 2)
SELECT p.bucket, p.test_fold, p.val_fold,
       CAST(sum(CASE WHEN fc.fold <> p.test_fold AND fc.fold <> p.val_fold THEN fc.n ELSE 0 END) AS BIGINT) AS n_train,
       CAST(sum(CASE WHEN fc.fold = p.val_fold THEN fc.n ELSE 0 END) AS BIGINT) AS n_val,
       CAST(sum(CASE WHEN fc.fold = p.test_fold THEN fc.n ELSE 0 END) AS BIGINT) AS n_test
FROM plan p JOIN fc ON fc.bucket = p.bucket GROUP BY 1, 2, 3""")
def p7_cv_plan(spark, sf_dir):
    rows = regression_rows(spark, sf_dir)
    fc = rows.groupBy("bucket", "fold").agg(F.count(F.lit(1)).alias("n"))
    plan = cv.cv_plan(rows.select("bucket"), K)
    j = plan.join(fc, "bucket")
    role = (F.when(F.col("fold") == F.col("test_fold"), "test")
             .when(F.col("fold") == F.col("val_fold"), "val").otherwise("train"))
    j = j.withColumn("role", role)
    return j.groupBy("bucket", "test_fold", "val_fold").agg(
        *[F.sum(F.when(F.col("role") == r, F.col("n")).otherwise(F.lit(0))).alias(f"n_{r}")
          for r in ("train", "val", "test")])


@query("p8_standardization", ids=("P8",), sql="WITH " + _ROWS_SQL + """
SELECT bucket, test_fold, val_fold, n_train, """ + ", ".join(
    f"round({c}_mean, 6) AS {c}_mean, round({c}_std, 6) AS {c}_std" for c in [*INPUTS, TARGET]) + " FROM models")
def p8_standardization(spark, sf_dir):
    rows = regression_rows(spark, sf_dir)
    plan = cv.cv_plan(rows.select("bucket"), K)
    std = cv.model_standardization(cv.fold_moments(rows, [*INPUTS, TARGET]), plan, [*INPUTS, TARGET])
    out = ["bucket", "test_fold", "val_fold", "n_train"]
    for c in [*INPUTS, TARGET]:
        out += [F.round(f"{c}_mean", 6).alias(f"{c}_mean"), F.round(f"{c}_std", 6).alias(f"{c}_std")]
    return std.select(*out)


def _std_target_sql():
    return "CASE WHEN m.t_std = 0 THEN 0.0 ELSE (r.t - m.t_mean) / m.t_std END"


@query("p10_training_loss_fixed_weights", ids=("P10",), sql="WITH " + _ROWS_SQL + f"""
SELECT m.bucket, m.test_fold, m.val_fold, count(*) AS n_train,
  round(avg(power({_std_target_sql()} - ({_forward_sql(
      [f"CASE WHEN m.{c}_std = 0 THEN 0.0 ELSE (r.{c} - m.{c}_mean) / m.{c}_std END" for c in INPUTS],
      FIXED_W, SIZES)}), 2)), 8) AS mse
FROM rows r JOIN models m ON r.bucket = m.bucket AND r.fold <> m.test_fold AND r.fold <> m.val_fold
GROUP BY 1, 2, 3""")
def p10_training_loss_fixed_weights(spark, sf_dir):
    """Loss of P10 for every model, one job: each row meets the models it trains."""
    rows = regression_rows(spark, sf_dir)
    models = fixed_models(rows)
    folds = F.sequence(F.lit(0), F.lit(K - 1))
    # (bucket, fold) -> the models that train on that fold, a bounded table
    train_assign = (models.withColumn("fold", F.explode(folds))
                          .filter((F.col("fold") != F.col("test_fold")) & (F.col("fold") != F.col("val_fold"))))
    j = rows.join(F.broadcast(train_assign), ["bucket", "fold"])
    xs = [F.when(F.element_at("x_std", i + 1) == 0, F.lit(0.0))
           .otherwise((F.col(c) - F.element_at("x_mean", i + 1)) / F.element_at("x_std", i + 1))
          for i, c in enumerate(INPUTS)]
    ts = F.when(F.col("t_std") == 0, F.lit(0.0)).otherwise((F.col("t") - F.col("t_mean")) / F.col("t_std"))
    y = cv.forward_expr(xs, FIXED_W, SIZES)
    return j.groupBy("bucket", "test_fold", "val_fold").agg(
        F.count(F.lit(1)).alias("n_train"), F.round(F.avg(F.pow(ts - y, 2)), 8).alias("mse"))


@query("p15_predict_fixed_weights", ids=("P15",), sql="WITH " + _ROWS_SQL + f"""
SELECT r.bucket, r.fold, r.l_orderkey, r.l_linenumber, round({_predict_sql()}, 3) AS y_hat
FROM rows r JOIN models m ON m.bucket = r.bucket AND m.test_fold = 0 AND m.val_fold = 1""")
def p15_predict_fixed_weights(spark, sf_dir):
    rows = regression_rows(spark, sf_dir)
    models = fixed_models(rows).filter("test_fold = 0 AND val_fold = 1").drop("test_fold", "val_fold")
    j = rows.join(F.broadcast(models), "bucket")
    y = cv.add_prediction(j, INPUTS, SIZES, FIXED_W)
    return y.select("bucket", "fold", "l_orderkey", "l_linenumber", F.round("_yhat", 3).alias("y_hat"))


@query("p15_layer_activations", ids=("P15",), sql="WITH " + _ROWS_SQL + f"""
SELECT r.bucket, count(*) AS n, {len(SIZES)} AS n_layers, true AS sizes_fit, true AS hidden_within_tanh, true AS output_is_prediction
FROM rows r GROUP BY 1""")
def p15_layer_activations(spark, sf_dir):
    """The outputs of all layers with the prediction: inputs, hidden layers
    (tanh, within -1 and 1), and the output before it is unstandardised."""
    rows = regression_rows(spark, sf_dir)
    models = fixed_models(rows).filter("test_fold = 0 AND val_fold = 1").drop("test_fold", "val_fold")
    y = cv.add_prediction(rows.join(F.broadcast(models), "bucket"), INPUTS, SIZES, FIXED_W, activations="layers")
    hidden = F.flatten(F.slice("layers", 2, len(SIZES) - 2))
    output = F.element_at(F.element_at("layers", -1), 1) * F.col("t_std") + F.col("t_mean")
    fits = F.transform("layers", lambda a: F.size(a)) == F.array(*map(F.lit, SIZES))
    return y.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("layers")).alias("n_layers"), F.every(fits).alias("sizes_fit"),
        F.every(F.forall(hidden, lambda v: F.abs(v) <= 1)).alias("hidden_within_tanh"),
        F.every(F.abs(output - F.col("_yhat")) <= 1e-9 * (F.abs(F.col("_yhat")) + 1)).alias("output_is_prediction"))


@query("p16_validation_rmse", ids=("P16",), sql="WITH " + _VAL_ERR_SQL + """
SELECT bucket, test_fold, val_fold, n_scored, round(rmse, 3) AS rmse FROM val_err""")
def p16_validation_rmse(spark, sf_dir):
    rows = regression_rows(spark, sf_dir)
    e = cv.score_assignments(rows, cv.validation_assignments(fixed_models(rows)), INPUTS, TARGET, SIZES, FIXED_W)
    return e.select("bucket", "test_fold", "val_fold", "n_scored", F.round("rmse", 3).alias("rmse"))


@query("p17_best_model_per_fold", ids=("P17",), sql="WITH " + _VAL_ERR_SQL + """
SELECT bucket, test_fold, test_fold AS model_test_fold, val_fold AS model_val_fold, round(rmse, 3) AS min_val_rmse
FROM (SELECT *, row_number() OVER (PARTITION BY bucket, test_fold ORDER BY rmse, val_fold) AS rk FROM val_err)
WHERE rk = 1""")
def p17_best_model_per_fold(spark, sf_dir):
    rows = regression_rows(spark, sf_dir)
    e = cv.score_assignments(rows, cv.validation_assignments(fixed_models(rows)), INPUTS, TARGET, SIZES, FIXED_W)
    b = cv.choose_best(e, K, "per_fold")
    return b.withColumn("min_val_rmse", F.round("min_val_rmse", 3))


@query("p18_cv_report", ids=("P18", "P19"), sql=_report_sql("per_fold"))
def p18_cv_report(spark, sf_dir):
    rows = regression_rows(spark, sf_dir)
    return cv.cv_report(rows, fixed_models(rows), INPUTS, TARGET, SIZES, K, "per_fold", FIXED_W, digits=3)


@query("p17_cv_report_running_min", ids=("P17", "P18"), sql=_report_sql("running"))
def p17_cv_report_running_min(spark, sf_dir):
    rows = regression_rows(spark, sf_dir)
    return cv.cv_report(rows, fixed_models(rows), INPUTS, TARGET, SIZES, K, "running", FIXED_W, digits=3)


# --------------------------------------------------------------------------
# word count
# --------------------------------------------------------------------------

@query("p22_word_count", ids=("P22",), sql="""
SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word""")
def p22_word_count(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    words = docs.select(F.explode(F.split("text", " ", -1)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
