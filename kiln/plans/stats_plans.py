"""Statistics, evaluation metrics, distributed matrices."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import matrices, stats
from kiln.operators import windows as win
from kiln.plans.registry import query
from kiln.sources.tables import table


@query("m19_column_statistics", ids=("M19",), sql="""
WITH x AS (SELECT CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS dim, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
SELECT dim, count(v) AS count, round(avg(v), 8) AS mean, round(var_samp(v), 8) AS variance,
       count(*) FILTER (WHERE v <> 0) AS num_nonzeros, max(v) AS max, min(v) AS min,
       round(sum(abs(v)), 6) AS norm_l1, round(sqrt(sum(v * v)), 8) AS norm_l2
FROM x GROUP BY dim""")
def m19_column_statistics(spark, sf_dir):
    s = stats.col_stats(table(spark, sf_dir, "embeddings"), "embedding")
    return s.select("dim", "count", F.round("mean", 8).alias("mean"), F.round("variance", 8).alias("variance"),
                    "num_nonzeros", "max", "min", F.round("norm_l1", 6).alias("norm_l1"),
                    F.round("norm_l2", 8).alias("norm_l2"))


_LI_COLS = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]


@query("m20_pearson_matrix", ids=("M20", "A11"), sql=" UNION ALL ".join(
    f"SELECT '{a}' AS i, '{b}' AS j, round(corr({a}, {b}), 8) AS corr FROM lineitem" for a in _LI_COLS for b in _LI_COLS))
def m20_pearson_matrix(spark, sf_dir):
    m = stats.correlation_matrix(table(spark, sf_dir, "lineitem"), _LI_COLS, "pearson")
    return m.withColumn("corr", F.round("corr", 8))


_SP_COLS = ["o_totalprice", "o_custkey", "day_no"]


@query("m20_spearman_matrix", ids=("M20",), sql="""
WITH x AS (SELECT o_orderkey, o_totalprice, o_custkey, CAST(datediff('day', DATE '1990-01-01', o_orderdate) AS INTEGER) AS day_no FROM orders),
r AS (SELECT o_orderkey,
  rank() OVER (ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY o_totalprice) - 1) / 2.0 AS r0,
  rank() OVER (ORDER BY o_custkey) + (count(*) OVER (PARTITION BY o_custkey) - 1) / 2.0 AS r1,
  rank() OVER (ORDER BY day_no) + (count(*) OVER (PARTITION BY day_no) - 1) / 2.0 AS r2 FROM x)
""" + " UNION ALL ".join(f"SELECT '{_SP_COLS[a]}' AS i, '{_SP_COLS[b]}' AS j, round(corr(r{a}, r{b}), 8) AS corr FROM r"
                         for a in range(3) for b in range(3)))
def m20_spearman_matrix(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_custkey",
        F.datediff(F.to_date("o_orderdate"), F.lit("1990-01-01").cast("date")).alias("day_no"))
    m = stats.correlation_matrix(o, _SP_COLS, "spearman", id_col="o_orderkey")
    return m.withColumn("corr", F.round("corr", 8))


@query("m21_chi_square_independence", ids=("M21",), sql="""
WITH cells AS (SELECT l_returnflag, l_linestatus, count(*) AS o FROM lineitem GROUP BY 1, 2),
ra AS (SELECT l_returnflag, count(*) AS ra FROM lineitem GROUP BY 1),
cb AS (SELECT l_linestatus, count(*) AS cb FROM lineitem GROUP BY 1),
n AS (SELECT count(*) AS n FROM lineitem),
grid AS (SELECT ra.l_returnflag, cb.l_linestatus, ra.ra * cb.cb / n.n AS e FROM ra, cb, n)
SELECT round(sum(power(coalesce(c.o, 0) - g.e, 2) / g.e), 6) AS statistic,
       CAST(((SELECT count(*) FROM ra) - 1) * ((SELECT count(*) FROM cb) - 1) AS INTEGER) AS dof
FROM grid g LEFT JOIN cells c USING (l_returnflag, l_linestatus)""")
def m21_chi_square_independence(spark, sf_dir):
    t = stats.chi_square_independence(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus")
    return t.select(F.round("statistic", 6).alias("statistic"), "dof")


@query("m21_chi_square_goodness_of_fit", ids=("M21",), sql="""
WITH c AS (SELECT o_orderpriority, count(*) AS o FROM orders GROUP BY 1), n AS (SELECT count(*) AS n FROM orders)
SELECT round(sum(power(o - n / 5.0, 2) / (n / 5.0)), 6) AS statistic, 4 AS dof FROM c, n""")
def m21_chi_square_goodness_of_fit(spark, sf_dir):
    pri = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    t = stats.chi_square_goodness_of_fit(table(spark, sf_dir, "orders"), "o_orderpriority", {p: 1.0 for p in pri})
    return t.select(F.round("statistic", 6).alias("statistic"), "dof")


@query("m21_ks_and_feature_chi_square", ids=("M21",))
def m21_ks_and_feature_chi_square(spark, sf_dir):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import ChiSquareTest, KolmogorovSmirnovTest
    li = table(spark, sf_dir, "lineitem")
    z = li.select(((F.col("l_quantity") - 25.5) / 14.43).alias("z"))
    ks = KolmogorovSmirnovTest.test(z, "z", "norm", 0.0, 1.0).select(
        F.lit("ks").alias("test"), F.col("statistic").alias("statistic"), F.col("pValue").alias("p_value"))
    feats = VectorAssembler(inputCols=["ls"], outputCol="features").transform(
        li.select((F.col("l_linestatus") == "F").cast("double").alias("ls"),
                  (F.col("l_returnflag") == "R").cast("double").alias("label")))
    from pyspark.ml.functions import vector_to_array
    chi = ChiSquareTest.test(feats, "features", "label").select(
        F.lit("chi2").alias("test"), vector_to_array("statistics")[0].alias("statistic"),
        vector_to_array("pValues")[0].alias("p_value"))
    return ks.unionByName(chi)


@query("m22_kernel_density", ids=("M22",), sql="""
WITH p AS (SELECT unnest([0.0, 0.02, 0.05, 0.08, 0.1]::DOUBLE[]) AS point)
SELECT point, round(avg(exp(-power((l_discount - point) / 0.01, 2) / 2) / (0.01 * sqrt(2 * pi()))), 6) AS density
FROM lineitem, p GROUP BY point""")
def m22_kernel_density(spark, sf_dir):
    k = stats.kernel_density(table(spark, sf_dir, "lineitem"), "l_discount", [0.0, 0.02, 0.05, 0.08, 0.1], 0.01)
    return k.withColumn("density", F.round("density", 6))


def _scored_docs(spark, sf_dir):
    lab = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "text")
    return lab.join(docs, "doc_id")


@query("m23_roc_auc_rank_sum", ids=("M23",), sql="""
WITH s AS (SELECT n_chars AS score, quality AS label FROM labels JOIN documents USING (doc_id)),
r AS (SELECT *, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM s)
SELECT round((sum(rk) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)
        / (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label <> 1)), 8) AS auc,
       count(*) FILTER (WHERE label = 1) AS n_pos, count(*) FILTER (WHERE label <> 1) AS n_neg FROM r""")
def m23_roc_auc_rank_sum(spark, sf_dir):
    d = _scored_docs(spark, sf_dir).select(F.col("n_chars").alias("score"), F.col("quality").alias("label"))
    return stats.roc_auc(d, "score", "label").withColumn("auc", F.round("auc", 8))


@query("m23_binary_evaluator", ids=("M23",), sql="""
WITH s AS (SELECT CAST(n_chars AS DOUBLE) AS score, quality AS label FROM labels JOIN documents USING (doc_id)),
r AS (SELECT *, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM s),
n AS (SELECT count(*) FILTER (WHERE label = 1) AS np, count(*) FILTER (WHERE label <> 1) AS nn FROM s),
t AS (SELECT score, count(*) FILTER (WHERE label = 1) AS tp, count(*) AS k FROM s GROUP BY score),
c AS (SELECT score, sum(tp) OVER (ORDER BY score DESC) AS tp, sum(k) OVER (ORDER BY score DESC) AS k FROM t),
pr AS (SELECT tp / np AS recall, tp / k AS precision,
              lag(tp / np, 1, 0) OVER (ORDER BY score DESC) AS before, lag(tp / k) OVER (ORDER BY score DESC) AS was FROM c, n)
SELECT 'areaUnderROC' AS metric,
       round(((SELECT sum(rk) FROM r WHERE label = 1) - np * (np + 1) / 2.0) / (np * nn), 6) AS value FROM n
UNION ALL SELECT 'areaUnderPR', round(sum((recall - before) * (precision + coalesce(was, precision)) / 2), 6) FROM pr""")
def m23_binary_evaluator(spark, sf_dir):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    d = _scored_docs(spark, sf_dir).select(F.col("n_chars").cast("double").alias("rawPrediction"),
                                           F.col("quality").cast("double").alias("label"))
    ev = BinaryClassificationEvaluator(numBins=0)          # every distinct score is a point of the curve
    roc = ev.setMetricName("areaUnderROC").evaluate(d)
    pr = ev.setMetricName("areaUnderPR").evaluate(d)
    return spark.createDataFrame([("areaUnderROC", round(roc, 6)), ("areaUnderPR", round(pr, 6))], "metric string, value double")


@query("m24_regression_metrics", ids=("M24",), sql="""
WITH x AS (SELECT l_extendedprice AS y, l_quantity * 2000.0 AS p FROM lineitem), m AS (SELECT avg(y) AS ybar FROM x)
SELECT round(avg(power(p - ybar, 2)), 2) AS explained_variance, round(avg(abs(p - y)), 6) AS mae,
       round(avg(power(p - y, 2)), 2) AS mse, round(sqrt(avg(power(p - y, 2))), 6) AS rmse,
       round(1 - sum(power(p - y, 2)) / sum(power(y - ybar, 2)), 8) AS r2 FROM x, m""")
def m24_regression_metrics(spark, sf_dir):
    x = table(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 2000.0).alias("p"))
    m = stats.regression_metrics(x, "p", "y")
    return m.select(*[F.round(c, d).alias(c) for c, d in (("explained_variance", 2), ("mae", 6), ("mse", 2), ("rmse", 6), ("r2", 8))])


@query("m24_regression_metrics_streamlined", ids=("M24",), sql="""
WITH x AS (SELECT l_quantity + 1e9 AS y, l_linenumber * 10 + 1e9 AS p FROM lineitem),
m AS (SELECT avg(y - 1e9) + 1e9 AS ybar FROM x)
SELECT round(avg(power(p - ybar, 2)), 3) AS explained_variance, round(avg(abs(p - y)), 6) AS mae,
       round(avg(power(p - y, 2)), 4) AS mse, round(1 - avg(power(p - y, 2)) / avg(power(y - ybar, 2)), 4) AS r2 FROM x, m""")
def m24_regression_metrics_streamlined(spark, sf_dir):
    """Values near 1e9, where uncentred sums of squares lose all digits."""
    x = table(spark, sf_dir, "lineitem").select((F.col("l_quantity") + 1e9).alias("y"), (F.col("l_linenumber") * 10 + 1e9).alias("p"))
    m = stats.regression_metrics(x, "p", "y")
    return m.select(F.round("explained_variance", 3).alias("explained_variance"), F.round("mae", 6).alias("mae"),
                    F.round("mse", 4).alias("mse"), F.round("r2", 4).alias("r2"))


_CLASS_SQL = """
WITH x AS (SELECT label, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS prediction FROM embeddings),
cm AS (SELECT label, prediction, count(*) AS n FROM x GROUP BY 1, 2),
lab AS (SELECT label FROM cm UNION SELECT prediction FROM cm),
s AS (SELECT l.label, coalesce((SELECT sum(n) FROM cm WHERE cm.label = l.label), 0) AS support,
             coalesce((SELECT sum(n) FROM cm WHERE cm.prediction = l.label), 0) AS predicted,
             coalesce((SELECT sum(n) FROM cm WHERE cm.label = l.label AND cm.prediction = l.label), 0) AS tp FROM lab l),
pl AS (SELECT label, support, tp, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision,
  CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall,
  CASE WHEN tp > 0 THEN 2 * (tp / predicted) * (tp / support) / (tp / predicted + tp / support) ELSE 0 END AS f1,
  (predicted - tp) / ((SELECT sum(n) FROM cm) - support) AS false_positive_rate FROM s)"""


def _classified(spark, sf_dir):
    """The largest element's position as the predicted class."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("label", (F.array_position("embedding", F.array_max("embedding")) - 1).cast("int").alias("prediction"))


@query("m25_multiclass_metrics", ids=("M25",), sql=_CLASS_SQL + """
SELECT label, CAST(support AS BIGINT) AS support, CAST(tp AS BIGINT) AS tp, round(precision, 8) AS precision,
  round(recall, 8) AS recall, round(f1, 8) AS f1, round(false_positive_rate, 8) AS false_positive_rate FROM pl""")
def m25_multiclass_metrics(spark, sf_dir):
    m = stats.multiclass_metrics(_classified(spark, sf_dir), "prediction", "label")
    return m.select("label", "support", "tp", *[F.round(c, 8).alias(c) for c in ("precision", "recall", "f1", "false_positive_rate")])


@query("m25_confusion_matrix", ids=("M25",), sql=_CLASS_SQL + " SELECT label, prediction, n FROM cm")
def m25_confusion_matrix(spark, sf_dir):
    return stats.confusion_matrix(_classified(spark, sf_dir), "prediction", "label")


@query("m25_weighted_metrics", ids=("M25",), sql=_CLASS_SQL + """
SELECT round(sum(tp) / sum(support), 8) AS accuracy, round(sum(precision * support) / sum(support), 8) AS weighted_precision,
  round(sum(recall * support) / sum(support), 8) AS weighted_recall, round(sum(f1 * support) / sum(support), 8) AS weighted_f1,
  round(sum(false_positive_rate * support) / sum(support), 8) AS weighted_false_positive_rate FROM pl""")
def m25_weighted_metrics(spark, sf_dir):
    m = stats.weighted_multiclass_metrics(_classified(spark, sf_dir), "prediction", "label")
    return m.select(*[F.round(c, 8).alias(c) for c in m.columns])


@query("m26_ranking_metrics", ids=("M26",), sql="""
WITH r AS (SELECT o_custkey AS q, o_orderkey AS item,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) - 1 AS pos,
             CAST(o_orderstatus = 'F' AS INTEGER) AS rel FROM orders),
h AS (SELECT *, sum(rel) OVER (PARTITION BY q ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hits FROM r),
pq AS (SELECT q, sum(CASE WHEN pos < 3 THEN rel ELSE 0 END) AS hits_k,
              sum(CASE WHEN rel = 1 THEN hits / (pos + 1) ELSE 0 END) AS ap_sum,
              sum(CASE WHEN pos < 3 AND rel = 1 THEN 1 / log2(pos + 2) ELSE 0 END) AS dcg, sum(rel) AS nrel FROM h GROUP BY q),
pi AS (SELECT *, CASE WHEN nrel > 0 THEN list_sum(list_transform(range(CAST(least(nrel, 3) AS BIGINT)), lambda i: 1 / log2(i + 2))) ELSE 0 END AS idcg FROM pq)
SELECT round(avg(hits_k / 3.0), 8) AS precision_at_k,
       round(avg(CASE WHEN nrel > 0 THEN ap_sum / nrel ELSE 0 END), 8) AS mean_avg_precision,
       round(avg(CASE WHEN idcg > 0 THEN dcg / idcg ELSE 0 END), 8) AS ndcg_at_k, count(*) AS n_queries FROM pi""")
def m26_ranking_metrics(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    ranked = win.with_position(o.withColumn("_neg", -F.col("o_totalprice")), ["o_custkey"], ["_neg", "o_orderkey"], "pos")
    relevant = o.where("o_orderstatus = 'F'")
    m = stats.ranking_metrics(ranked, relevant, "o_custkey", "o_orderkey", "pos", 3)
    return m.select(*[F.round(c, 8).alias(c) for c in ("precision_at_k", "mean_avg_precision", "ndcg_at_k")], "n_queries")


@query("m27_multilabel_metrics", ids=("M27",), sql="""
WITH x AS (SELECT list_filter(['doc', CASE WHEN quality = 1 THEN 'q' END, CASE WHEN toxic = 1 THEN 't' END], lambda v: v IS NOT NULL) AS l,
                  list_filter(['doc', CASE WHEN n_chars > 5000 THEN 'q' END, CASE WHEN contains(text, '!') THEN 't' END], lambda v: v IS NOT NULL) AS p
           FROM labels JOIN documents USING (doc_id)),
y AS (SELECT len(list_intersect(p, l)) AS i, len(list_distinct(list_concat(p, l))) AS u, len(p) AS np, len(l) AS nl,
             list_sort(p) = list_sort(l) AS eq FROM x)
SELECT round(avg(CAST(eq AS DOUBLE)), 8) AS subset_accuracy, round(avg(i / u), 8) AS accuracy,
       round(sum(np + nl - 2 * i) / (count(*) * 3.0), 8) AS hamming_loss, round(avg(i / np), 8) AS precision,
       round(avg(i / nl), 8) AS recall, round(avg(2 * i / (np + nl)), 8) AS f1,
       round(sum(i) / sum(np), 8) AS micro_precision, round(sum(i) / sum(nl), 8) AS micro_recall,
       round(2 * sum(i) / (sum(np) + sum(nl)), 8) AS micro_f1 FROM y""")
def m27_multilabel_metrics(spark, sf_dir):
    m = stats.multilabel_metrics(_label_sets(spark, sf_dir), "p", "l", 3)
    return m.select(*[F.round(c, 8).alias(c) for c in m.columns])


def _label_sets(spark, sf_dir):
    lab = F.array_compact(F.array(F.lit("doc"), F.when(F.col("quality") == 1, "q"), F.when(F.col("toxic") == 1, "t")))
    pred = F.array_compact(F.array(F.lit("doc"), F.when(F.col("n_chars") > 5000, "q"),
                                   F.when(F.col("text").contains("!"), "t")))
    return _scored_docs(spark, sf_dir).select(lab.alias("l"), pred.alias("p"))


@query("m27_multilabel_per_label", ids=("M27",), sql="""
WITH x AS (SELECT quality = 1 AS lq, toxic = 1 AS lt, n_chars > 5000 AS pq, contains(text, '!') AS pt
           FROM labels JOIN documents USING (doc_id)),
y AS (SELECT 'doc' AS label, true AS l, true AS p FROM x UNION ALL SELECT 'q', lq, pq FROM x UNION ALL SELECT 't', lt, pt FROM x),
z AS (SELECT label, count(*) FILTER (WHERE l) AS support, count(*) FILTER (WHERE p) AS predicted, count(*) FILTER (WHERE l AND p) AS tp
      FROM y WHERE l OR p GROUP BY label),
r AS (SELECT label, support, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision,
             CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall FROM z)
SELECT label, support, round(precision, 8) AS precision, round(recall, 8) AS recall,
       round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END, 8) AS f1 FROM r""")
def m27_multilabel_per_label(spark, sf_dir):
    m = stats.multilabel_label_metrics(_label_sets(spark, sf_dir), "p", "l")
    return m.select("label", "support", *[F.round(c, 8).alias(c) for c in ("precision", "recall", "f1")])


@query("m28_coordinate_matrix_blocks", ids=("M28",), sql="""
WITH e AS (SELECT vec_id AS i, CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS j, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
SELECT CAST(i // 128 AS BIGINT) AS block_row, CAST(j // 16 AS BIGINT) AS block_col, count(*) AS nnz, round(sum(v), 4) AS total,
       max(i) + 1 AS rows_upto, max(j) + 1 AS cols_upto FROM e GROUP BY 1, 2""")
def m28_coordinate_matrix_blocks(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    coo = e.select(F.col("vec_id").alias("i"), F.posexplode("embedding").alias("j", "v")) \
           .select("i", F.col("j").cast("long").alias("j"), F.col("v").cast("double").alias("v"))
    blocks = coo.groupBy(F.floor(F.col("i") / 128).cast("long").alias("block_row"),
                         F.floor(F.col("j") / 16).cast("long").alias("block_col"))
    return blocks.agg(F.count(F.lit(1)).alias("nnz"), F.round(F.sum("v"), 4).alias("total"),
                      (F.max("i") + 1).alias("rows_upto"), (F.max("j") + 1).alias("cols_upto"))


@query("m28_indexed_rows", ids=("M28",), sql="""
WITH e AS (SELECT vec_id AS i, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS j, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
SELECT i, count(*) AS n_entries, min(j) AS first_col, round(sum(v * (j + 1)), 4) AS weighted FROM e GROUP BY i""")
def m28_indexed_rows(spark, sf_dir):
    """Coordinate entries regrouped into rows (IndexedRowMatrix); a row is at
    most the number of columns, so the per-row group is bounded."""
    e = table(spark, sf_dir, "embeddings")
    coo = e.select(F.col("vec_id").alias("i"), F.posexplode("embedding").alias("j", "v"))
    rows = coo.groupBy("i").agg(F.sort_array(F.collect_list(F.struct("j", F.col("v").cast("double").alias("v")))).alias("entries"))
    return rows.select("i", F.size("entries").cast("long").alias("n_entries"), F.col("entries")[0]["j"].alias("first_col"),
                       F.round(F.aggregate("entries", F.lit(0.0), lambda acc, s: acc + s["v"] * (s["j"] + 1)), 4).alias("weighted"))


@query("m28_conversions", ids=("M28",), sql="""
SELECT vec_id AS i, CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS j, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings""")
def m28_conversions(spark, sf_dir):
    """Vectors to coordinates, to blocks, to coordinates, to indexed rows, and
    back to coordinates: the same entries."""
    coo = matrices.from_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    again = matrices.blocks_to_coordinate(matrices.to_blocks(coo, 128, 16), 128, 16)
    return matrices.rows_to_coordinate(matrices.to_rows(again))


@query("m28_dimensions", ids=("M28",), sql="""
SELECT max(vec_id) + 1 AS rows, CAST(max(len(embedding)) AS BIGINT) AS cols, CAST(sum(len(embedding)) AS BIGINT) AS entries FROM embeddings""")
def m28_dimensions(spark, sf_dir):
    return matrices.dimensions(matrices.from_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"))


@query("m29_append_bias", ids=("M29",), sql="""
SELECT vec_id, CAST(len(list_concat(embedding, [1.0::FLOAT])) AS INTEGER) AS size_,
       list_concat(embedding, [1.0::FLOAT])[-1] AS last_ FROM embeddings""")
def m29_append_bias(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    biased = F.concat("embedding", F.array(F.lit(1.0).cast("float")))
    return e.select("vec_id", F.size(biased).alias("size_"), F.element_at(biased, -1).alias("last_"))
