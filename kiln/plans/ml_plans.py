"""Feature transformers, estimators and their exact SQL forms.

Library fits (pyspark.ml) give rows-only checks; wherever the output is
exact (binarizer, bucketizer, string indexing, tokenizing, exact TF-IDF,
vector transforms, one-feature OLS, fixed-centre assignment, frequent
single items) the same result is also computed with built-in expressions
and checked against SQL.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from kiln.operators.indexing import zip_with_index
from kiln.operators.joins import lookup
from kiln.operators.partitioning import repartition_and_sort
from kiln.plans.registry import query
from kiln.session import materialize, partitions_for
from kiln.sources.tables import table
from kiln.streaming.models import assign_clusters

#: Bytes of text that one task of a word2vec fit trains on.
WORD2VEC_BYTES = 16 << 20

#: Bytes of text that a task of the exact TF-IDF reads, about.
ID_BYTES = 32 << 20

#: Edges of a graph that a cell of its grid has, about, and edges that are worth a cell at all.
CELL_EDGES, LEAST_CELL_EDGES = 500_000, 50_000

#: Ratings of a factorization's block at most, about; a task holds a block several times over while it sorts it.  And the
#: blocks of few ratings, Spark's default.
ALS_BLOCK_RATINGS, ALS_LEAST_BLOCKS = 4_000_000, 10


def _emb(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "embedding", F.col("label").cast("double").alias("label"),
                    array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


def _li_features(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag",
                     (F.col("l_extendedprice") / 1000).alias("y"))


# ---------------------------------------------------------------- exact (Q)

@query("m3_binarizer_bucketizer", ids=("M3",), sql="""
SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0.05 THEN 1.0 ELSE 0.0 END AS discount_flag,
  CASE WHEN l_quantity < 10 THEN 0.0 WHEN l_quantity < 20 THEN 1.0 WHEN l_quantity < 30 THEN 2.0 ELSE 3.0 END AS qty_bucket
FROM lineitem""")
def m3_binarizer_bucketizer(spark, sf_dir):
    from pyspark.ml.feature import Binarizer, Bucketizer
    li = _li_features(spark, sf_dir)
    b = Binarizer(threshold=0.05, inputCol="l_discount", outputCol="discount_flag").transform(li)
    z = Bucketizer(splits=[-float("inf"), 10, 20, 30, float("inf")], inputCol="l_quantity",
                   outputCol="qty_bucket").transform(b)
    return z.select("l_orderkey", "l_linenumber", "discount_flag", "qty_bucket")


@query("m4_string_indexer", ids=("M4",), sql="""
WITH c AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1),
idx AS (SELECT p_brand, CAST(row_number() OVER (ORDER BY n DESC, p_brand) - 1 AS DOUBLE) AS brand_index FROM c)
SELECT p_partkey, brand_index FROM part JOIN idx USING (p_brand)""")
def m4_string_indexer(spark, sf_dir):
    from pyspark.ml.feature import StringIndexer
    p = table(spark, sf_dir, "part")
    model = StringIndexer(inputCol="p_brand", outputCol="brand_index", stringOrderType="frequencyDesc").fit(p)
    return model.transform(p).select("p_partkey", "brand_index")


@query("m4_one_hot_and_vector_indexer", ids=("M4",), sql="""
WITH c AS (SELECT p_type, count(*) AS n FROM part GROUP BY 1),
idx AS (SELECT p_type, CAST(row_number() OVER (ORDER BY n DESC, p_type) - 1 AS DOUBLE) AS type_idx FROM c),
k AS (SELECT count(*) AS k FROM c)
SELECT p_partkey, type_idx, list_transform(range(k - 1), lambda i: CASE WHEN i = type_idx THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS one_hot,
       [type_idx, CAST(p_size AS DOUBLE)] AS assembled FROM part JOIN idx USING (p_type), k""")
def m4_one_hot_and_vector_indexer(spark, sf_dir):
    """Indexed and one-hot types; the vector indexer keeps a feature with too
    many values for a category as it is, and numbers the others' values, here
    0 to k - 1 already."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler, VectorIndexer
    p = table(spark, sf_dir, "part")
    pipe = Pipeline(stages=[
        StringIndexer(inputCol="p_type", outputCol="type_idx"),
        OneHotEncoder(inputCols=["type_idx"], outputCols=["type_vec"], dropLast=True),
        VectorAssembler(inputCols=["type_idx", "p_size"], outputCol="raw"),
        VectorIndexer(inputCol="raw", outputCol="indexed", maxCategories=2)])
    out = pipe.fit(p).transform(p)
    return out.select("p_partkey", "type_idx", vector_to_array("type_vec").alias("one_hot"), vector_to_array("indexed").alias("assembled"))


@query("m5_regex_tokenizer_ngram", ids=("M5",), sql="""
WITH t AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '\\W+'), lambda w: length(w) >= 1) AS toks FROM documents),
b AS (SELECT doc_id, toks, list_transform(range(1, greatest(len(toks), 1)), lambda i: toks[i] || ' ' || toks[i + 1]) AS bigrams FROM t)
SELECT doc_id, CAST(len(toks) AS INTEGER) AS n_tokens, CAST(len(bigrams) AS INTEGER) AS n_bigrams,
       md5(array_to_string(bigrams, '|')) AS all_bigrams FROM b""")
def m5_regex_tokenizer_ngram(spark, sf_dir):
    from pyspark.ml.feature import NGram, RegexTokenizer
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    tok = RegexTokenizer(inputCol="text", outputCol="toks", pattern="\\W+", gaps=True, minTokenLength=1,
                         toLowercase=True).transform(d)
    ng = NGram(n=2, inputCol="toks", outputCol="bigrams").transform(tok)
    return ng.select("doc_id", F.size("toks").alias("n_tokens"), F.size("bigrams").alias("n_bigrams"),
                     F.md5(F.array_join("bigrams", "|").cast("binary")).alias("all_bigrams"))


@query("m5_whitespace_tokenizer", ids=("M5",), sql="""
SELECT doc_id, CAST(len(string_split_regex(rtrim(lower(text), E' \\t\\n\\x0B\\f\\r'), '[ \\t\\n\\x0B\\f\\r]')) AS INTEGER) AS n_words FROM documents""")
def m5_whitespace_tokenizer(spark, sf_dir):
    from pyspark.ml.feature import Tokenizer
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return Tokenizer(inputCol="text", outputCol="words").transform(d).select("doc_id", F.size("words").alias("n_words"))


_TFIDF_SQL = """
WITH t AS (SELECT doc_id, unnest(list_filter(string_split_regex(lower(text), '\\W+'), lambda w: length(w) >= 1)) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
m AS (SELECT count(*) AS m FROM documents)
SELECT doc_id, count(*) AS n_terms, round(sum(tf * ln((m + 1.0) / (df + 1.0))), 4) AS tfidf_sum,
       round(max(tf * ln((m + 1.0) / (df + 1.0))), 6) AS tfidf_max
FROM tf JOIN df USING (term), m GROUP BY doc_id"""


@query("m6_exact_tf_idf", ids=("M6",), sql=_TFIDF_SQL)
def m6_exact_tf_idf(spark, sf_dir):
    """idf = ln((m + 1) / (df + 1)), tf = raw count.  The texts are split
    once, after rows of one id have met, so that neither the terms nor their
    weights are shuffled by document; a term's document frequency is joined back
    to its rows with frequent terms dealt over copies.  If an id has more text
    than a task should read, its terms are shuffled instead."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    m = d.count()
    most = d.groupBy("doc_id").agg(F.sum(F.octet_length("text")).alias("n")).agg(F.max("n")).first()[0]
    if (most or 0) <= ID_BYTES:
        d = d.repartition(partitions_for(d, ID_BYTES), "doc_id")
    terms = d.select("doc_id", F.explode(F.filter(F.split(F.lower("text"), "\\W+"), lambda w: F.length(w) >= 1)).alias("term"))
    tf = materialize(terms.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf")), "tf")
    df = materialize(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "df")
    w = lookup(tf, df.withColumn("_rows", F.col("df")), ["term"], "_rows")
    w = w.withColumn("w", F.col("tf") * F.log((F.lit(m) + 1.0) / (F.col("df") + 1.0)))
    return w.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_terms"), F.round(F.sum("w"), 4).alias("tfidf_sum"),
                                   F.round(F.max("w"), 6).alias("tfidf_max"))


@query("m6_hashing_tf_idf_library", ids=("M6",), sql="""
WITH t AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '\\W+'), lambda w: length(w) >= 1) AS toks FROM documents)
SELECT count(*) AS n, CAST(sum(len(toks)) AS DOUBLE) AS total_tf, true AS idf_lowers_common FROM t""")
def m6_hashing_tf_idf_library(spark, sf_dir):
    """Hashed term frequencies in 2^18 slots: their total over the corpus is
    exact whatever collides; the inverse document frequency of a slot falls
    as the documents that hold it rise."""
    from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
    from pyspark.ml.stat import Summarizer
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    pipe = Pipeline(stages=[RegexTokenizer(inputCol="text", outputCol="toks", pattern="\\W+", minTokenLength=1),
                            HashingTF(inputCol="toks", outputCol="tf", numFeatures=1 << 18), IDF(inputCol="tf", outputCol="tfidf")])
    model = pipe.fit(d)
    idf, df = np.asarray(model.stages[-1].idf), np.asarray(model.stages[-1].docFreq)
    falls = bool((np.diff(idf[np.argsort(df, kind="stable")]) <= 1e-12).all())
    total = model.transform(d).agg(F.count(F.lit(1)).alias("n"), Summarizer.sum(F.col("tf")).alias("s"))
    return total.select("n", F.aggregate(vector_to_array("s"), F.lit(0.0), lambda a, v: a + v).alias("total_tf"),
                        F.lit(falls).alias("idf_lowers_common"))


@query("m7_vector_transforms", ids=("M7",), sql="""
WITH e AS (SELECT vec_id, CAST(generate_subscripts(embedding, 1) AS INTEGER) AS j, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
c AS (SELECT j, avg(v) AS mu, stddev_samp(v) AS sd FROM e GROUP BY j),
l AS (SELECT vec_id, sqrt(sum(v * v)) AS l2, sum(v) AS s1, sum(v * v) AS s2 FROM e GROUP BY vec_id)
SELECT vec_id, round(any_value(l2), 8) AS l2_norm, round(sum(v / l2 * j), 6) AS unit_weighted, round(sum(v * j), 5) AS hadamard_sum,
       round(sum((v - mu) / sd * j), 4) AS scaled_weighted, round(any_value(s1 + (s1 * s1 + s2) / 2), 4) AS poly2_sum
FROM e JOIN c USING (j) JOIN l USING (vec_id) GROUP BY vec_id""")
def m7_vector_transforms(spark, sf_dir):
    """Normalizer (L2), ElementwiseProduct, StandardScaler (sample std) and
    PolynomialExpansion (degree 2) over all elements, as expressions.  Sums
    weighted by position stand for the vectors."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    moments = (e.select(F.posexplode("x").alias("j", "v")).groupBy("j").agg(F.avg("v").alias("mu"), F.stddev_samp("v").alias("sd"))
               .orderBy("j").collect())                                     # one row per element
    mu, sd = (F.array(*(F.lit(r[c]) for r in moments)) for c in ("mu", "sd"))
    place = F.transform(F.sequence(F.lit(1), F.size("x")), lambda i: i.cast("double"))

    def total(values):
        return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)

    def times(a, b):
        return F.zip_with(a, b, lambda p, q: p * q)

    l2 = F.sqrt(total(times("x", "x")))
    unit = F.transform("x", lambda v: v / F.col("l2"))
    scaled = F.zip_with(F.zip_with("x", mu, lambda v, m: v - m), sd, lambda v, d: v / d)
    s1, s2 = total("x"), total(times("x", "x"))
    return e.withColumn("l2", l2).select(
        "vec_id", F.round("l2", 8).alias("l2_norm"), F.round(total(times(unit, place)), 6).alias("unit_weighted"),
        F.round(total(times("x", place)), 5).alias("hadamard_sum"), F.round(total(times(scaled, place)), 4).alias("scaled_weighted"),
        F.round(s1 + (s1 * s1 + s2) / 2, 4).alias("poly2_sum"))


@query("m7_vector_transformers_library", ids=("M7",), sql="""
WITH e AS (SELECT vec_id, CAST(generate_subscripts(embedding, 1) AS INTEGER) AS j, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
c AS (SELECT j, avg(v) AS mu, stddev_samp(v) AS sd FROM e GROUP BY j),
l AS (SELECT vec_id, sqrt(sum(v * v)) AS l2, sum(v) AS s1, sum(v * v) AS s2, count(*) AS k FROM e GROUP BY vec_id)
SELECT vec_id, round(sum(v / l2), 6) AS unit_sum, round(sum((v - mu) / sd), 4) AS scaled_sum, round(sum(v * j), 5) AS had_sum,
       CAST(any_value(k + k * (k + 1) / 2) AS INTEGER) AS n_poly, round(any_value(s1 + (s1 * s1 + s2) / 2), 4) AS poly_sum
FROM e JOIN c USING (j) JOIN l USING (vec_id) GROUP BY vec_id""")
def m7_vector_transformers_library(spark, sf_dir):
    from pyspark.ml.feature import ElementwiseProduct, Normalizer, PolynomialExpansion, StandardScaler
    from pyspark.ml.linalg import Vectors
    e = _emb(spark, sf_dir)
    dim = len(e.first()["embedding"])
    pipe = Pipeline(stages=[
        Normalizer(inputCol="features", outputCol="unit", p=2.0),
        StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
        PolynomialExpansion(inputCol="features", outputCol="poly", degree=2),
        ElementwiseProduct(inputCol="features", outputCol="had", scalingVec=Vectors.dense([float(i + 1) for i in range(dim)]))])
    out = pipe.fit(e).transform(e)

    def total(c):
        return F.aggregate(vector_to_array(c), F.lit(0.0), lambda a, v: a + v)

    return out.select("vec_id", F.round(total("unit"), 6).alias("unit_sum"), F.round(total("scaled"), 4).alias("scaled_sum"),
                      F.round(total("had"), 5).alias("had_sum"), F.size(vector_to_array("poly")).alias("n_poly"),
                      F.round(total("poly"), 4).alias("poly_sum"))


@query("m12_ols_one_feature", ids=("M12",), sql="""
SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept, round(regr_r2(l_extendedprice, l_quantity), 8) AS r2
FROM lineitem GROUP BY 1""")
def m12_ols_one_feature(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_returnflag").agg(
        F.round(F.regr_slope("l_extendedprice", "l_quantity"), 6).alias("slope"),
        F.round(F.regr_intercept("l_extendedprice", "l_quantity"), 4).alias("intercept"),
        F.round(F.regr_r2("l_extendedprice", "l_quantity"), 8).alias("r2"))


_CENTRES_SQL = """
WITH x AS (SELECT vec_id, label, CAST(generate_subscripts(embedding, 1) AS INTEGER) AS d, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
c AS (SELECT label AS cluster, d, avg(v) AS cv FROM x GROUP BY 1, 2),
dist AS (SELECT x.vec_id, c.cluster, sum((x.v - c.cv) * (x.v - c.cv)) AS d2 FROM x JOIN c USING (d) GROUP BY 1, 2),
best AS (SELECT vec_id, arg_min(cluster, (d2, cluster)) AS cluster, min(d2) AS d2 FROM dist GROUP BY 1)"""


@query("m15_fixed_centre_assignment_cost", ids=("M15",), sql=_CENTRES_SQL + """
SELECT CAST(cluster AS INTEGER) AS cluster, count(*) AS n, round(sum(d2), 4) AS cost FROM best GROUP BY 1""")
def m15_fixed_centre_assignment_cost(spark, sf_dir):
    """Assignment to fixed centres (the per-label mean vectors) and the
    k-means cost; centres are a (labels x dims) table, bounded."""
    e = table(spark, sf_dir, "embeddings")
    x = e.select("label", F.posexplode(F.col("embedding").cast("array<double>")).alias("d", "v"))
    # the model: one centre per label that occurs, in label order
    rows = x.groupBy("label", "d").agg(F.avg("v").alias("cv")).orderBy("label", "d").collect()
    labels = sorted({r["label"] for r in rows})
    centres = np.array([[r["cv"] for r in rows if r["label"] == k] for k in labels])
    names = F.array(*map(F.lit, labels))
    a = assign_clusters(e.select("vec_id", "embedding"), "embedding", centres)
    xs = F.col("embedding").cast("array<double>")
    cl = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centres])
    d2 = F.aggregate(F.zip_with(xs, F.element_at(cl, F.col("cluster") + 1), lambda p, q: (p - q) * (p - q)),
                     F.lit(0.0), lambda acc, v: acc + v)
    return a.groupBy(F.get(names, F.col("cluster")).alias("cluster")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(d2), 4).alias("cost"))


_BASKETS_SQL = "WITH baskets AS (SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey),\nn AS (SELECT count(DISTINCT l_orderkey) AS n FROM baskets)"


def _frequent_items(spark, sf_dir, support):
    from pyspark.ml.fpm import FPGrowth
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    # a basket holds distinct brands: bounded by the brand domain, not by the
    # order's row count, and collect_set merges map-side
    baskets = (li.join(p, li.l_partkey == p.p_partkey).groupBy("l_orderkey")
                 .agg(F.collect_set("p_brand").alias("items")))
    return FPGrowth(itemsCol="items", minSupport=support, minConfidence=0.5).fit(baskets).freqItemsets


@query("m18_frequent_single_items", ids=("M18",), sql=_BASKETS_SQL + """
SELECT p_brand AS item, count(*) AS freq FROM baskets, n GROUP BY p_brand, n.n HAVING count(*) >= 0.05 * n.n""")
def m18_frequent_single_items(spark, sf_dir):
    fi = _frequent_items(spark, sf_dir, 0.05)
    return fi.where(F.size("items") == 1).select(F.col("items")[0].alias("item"), "freq")


@query("m18_frequent_item_sets", ids=("M18",), sql=_BASKETS_SQL + """
, s AS (SELECT [p_brand] AS items, count(*) AS freq FROM baskets GROUP BY 1
UNION ALL SELECT [a.p_brand, b.p_brand], count(*) FROM baskets a JOIN baskets b ON a.l_orderkey = b.l_orderkey AND a.p_brand < b.p_brand GROUP BY 1
UNION ALL SELECT [a.p_brand, b.p_brand, c.p_brand], count(*) FROM baskets a JOIN baskets b ON a.l_orderkey = b.l_orderkey AND a.p_brand < b.p_brand
  JOIN baskets c ON a.l_orderkey = c.l_orderkey AND b.p_brand < c.p_brand GROUP BY 1
UNION ALL SELECT [a.p_brand, b.p_brand, c.p_brand, d.p_brand], count(*) FROM baskets a JOIN baskets b ON a.l_orderkey = b.l_orderkey AND a.p_brand < b.p_brand
  JOIN baskets c ON a.l_orderkey = c.l_orderkey AND b.p_brand < c.p_brand JOIN baskets d ON a.l_orderkey = d.l_orderkey AND c.p_brand < d.p_brand GROUP BY 1)
SELECT array_to_string(items, ',') AS items, freq FROM s, n WHERE freq >= 0.01 * n.n AND len(items) <= 4""")
def m18_frequent_item_sets(spark, sf_dir):
    """Item sets of all sizes with support 0.01."""
    fi = _frequent_items(spark, sf_dir, 0.01)
    return fi.select(F.array_join(F.array_sort("items"), ",").alias("items"), "freq")


# ------------------------------------------------------- library fits (R)

@query("m1_chained_stages_logistic", ids=("M1", "M11"), sql="""
SELECT CAST(label % 2 AS DOUBLE) AS label, count(*) AS n, true AS classes_only, true AS by_threshold FROM embeddings GROUP BY 1""")
def m1_chained_stages_logistic(spark, sf_dir):
    """Scaler and logistic model chained.  Predictions are classes; with a
    threshold set they follow the probability, with it cleared (0: every
    probability counts) all rows are positive."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StandardScaler
    e = _emb(spark, sf_dir).withColumn("label", (F.col("label") % 2).cast("double"))
    model = Pipeline(stages=[StandardScaler(inputCol="features", outputCol="scaled"),
                             LogisticRegression(featuresCol="scaled", maxIter=20, regParam=0.01)]).fit(e)
    model.stages[-1].setThreshold(0.7)
    pred = model.transform(e)
    p = vector_to_array("probability")[1]
    by_threshold = F.col("prediction") == (p > 0.7).cast("double")
    return pred.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.every(F.col("prediction").isin(0.0, 1.0)).alias("classes_only"),
                                     F.every(by_threshold).alias("by_threshold"))


@query("m2_cross_validator", ids=("M2",), sql="""
SELECT unnest([0.0, 0.1, 1.0]::DOUBLE[]) AS reg_param, true AS rmse_below_label_spread""")
def m2_cross_validator(spark, sf_dir):
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    li = _li_features(spark, sf_dir).withColumn(
        "fold", F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_quantity"), F.lit(3)).cast("int"))
    data = VectorAssembler(inputCols=["l_quantity", "l_discount", "l_tax"], outputCol="features").transform(li)
    lr = LinearRegression(labelCol="y", maxIter=10)
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.0, 0.1, 1.0]).build()
    cv = CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=RegressionEvaluator(labelCol="y"),
                        numFolds=3, foldCol="fold")
    model = cv.fit(data)
    spread = data.agg(F.stddev_pop("y")).first()[0]
    return spark.createDataFrame([(float(p[lr.regParam]), bool(m <= 1.05 * spread)) for p, m in zip(grid, model.avgMetrics)],
                                 "reg_param double, rmse_below_label_spread boolean")


@query("m8_pca", ids=("M8",), sql="""
SELECT count(*) AS n, true AS variances_fall, true AS uncorrelated FROM embeddings""")
def m8_pca(spark, sf_dir):
    from pyspark.ml.feature import PCA
    e = _emb(spark, sf_dir)
    model = PCA(k=3, inputCol="features", outputCol="pcs").fit(e)
    x = model.transform(e).select(*(vector_to_array("pcs")[i].alias(f"p{i}") for i in range(3)))
    return x.agg(F.count(F.lit(1)).alias("n"),
                 ((F.var_samp("p0") >= F.var_samp("p1")) & (F.var_samp("p1") >= F.var_samp("p2"))).alias("variances_fall"),
                 (F.greatest(*(F.abs(F.corr(a, b)) for a, b in (("p0", "p1"), ("p0", "p2"), ("p1", "p2")))) < 1e-6).alias("uncorrelated"))


@query("m9_word2vec_synonyms", ids=("M9",), sql="""
SELECT 5 AS n, true AS similarities_are_cosines, true AS all_in_vocabulary""")
def m9_word2vec_synonyms(spark, sf_dir):
    from pyspark.ml.feature import RegexTokenizer, Word2Vec
    d = table(spark, sf_dir, "documents").select("text")
    toks = RegexTokenizer(inputCol="text", outputCol="toks", pattern="\\W+", minTokenLength=1).transform(d)
    # by default one task trains on all texts
    tasks = max(1, -(-(d.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // WORD2VEC_BYTES))
    model = Word2Vec(vectorSize=16, minCount=5, maxIter=1, seed=1, numPartitions=tasks, inputCol="toks", outputCol="vec").fit(toks)
    vectors = model.getVectors()
    found = model.findSynonyms(vectors.orderBy("word").first()["word"], 5)
    return found.join(vectors, "word", "left").agg(
        F.count(F.lit(1)).alias("n"), F.every(F.col("similarity").between(-1.0001, 1.0001)).alias("similarities_are_cosines"),
        F.every(F.col("vector").isNotNull()).alias("all_in_vocabulary"))


@query("m10_rformula_selector", ids=("M10",), sql="""
WITH c AS (SELECT l_returnflag, row_number() OVER (ORDER BY count(*) DESC, l_returnflag) - 1 AS i FROM lineitem GROUP BY 1)
SELECT l_orderkey, l_linenumber, [l_quantity, l_discount, l_tax, CASE WHEN i = 0 THEN 1.0 ELSE 0.0 END, CASE WHEN i = 1 THEN 1.0 ELSE 0.0 END]::DOUBLE[] AS features,
       round(l_extendedprice / 1000, 6) AS label FROM lineitem JOIN c USING (l_returnflag)""")
def m10_rformula_selector(spark, sf_dir):
    """Features and label of a formula: numbers as they are, the flag one-hot
    by frequency without its last value."""
    from pyspark.ml.feature import RFormula
    li = _li_features(spark, sf_dir)
    f = RFormula(formula="y ~ l_quantity + l_discount + l_tax + l_returnflag").fit(li).transform(li)
    return f.select("l_orderkey", "l_linenumber", vector_to_array("features").alias("features"), F.round("label", 6).alias("label"))


@query("m10_chi_square_selector", ids=("M10",), sql="""
SELECT l_orderkey, l_linenumber, CAST(l_linestatus = 'F' AS DOUBLE) AS selected FROM lineitem""")
def m10_chi_square_selector(spark, sf_dir):
    """Of three categorical features the chi-square test keeps the one that
    tells the most about the label: the status, which the label repeats."""
    from pyspark.ml.feature import UnivariateFeatureSelector, VectorAssembler
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_linestatus") == "F").cast("double").alias("status"),
        F.col("l_linenumber").cast("double").alias("line"), F.pmod("l_suppkey", F.lit(3)).cast("double").alias("supplier"),
        F.when(F.col("l_linestatus") == "F", 1.0).otherwise(0.0).alias("label"))
    f = VectorAssembler(inputCols=["line", "status", "supplier"], outputCol="features").transform(li)
    sel = UnivariateFeatureSelector(featuresCol="features", labelCol="label", outputCol="kept", selectionMode="numTopFeatures")
    sel = sel.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(1)
    return sel.fit(f).transform(f).select("l_orderkey", "l_linenumber", vector_to_array("kept")[0].alias("selected"))


@query("m11_svm_naive_bayes", ids=("M11",), sql="""
SELECT count(*) AS n, true AS classes_only, true AS one_sided_when_threshold_is_out_of_reach FROM embeddings""")
def m11_svm_naive_bayes(spark, sf_dir):
    from pyspark.ml.classification import LinearSVC, NaiveBayes
    e = _emb(spark, sf_dir).withColumn("label", (F.col("label") % 2).cast("double"))
    model = LinearSVC(maxIter=10, regParam=0.1).fit(e)
    svm = model.transform(e).select("vec_id", F.col("prediction").alias("svm"))
    model.setThreshold(1e9)
    none = model.transform(e).select("vec_id", F.col("prediction").alias("none"))
    pos = e.withColumn("features", array_to_vector(F.transform(F.col("embedding").cast("array<double>"),
                                                               lambda v: F.abs(v))))
    nb = NaiveBayes(smoothing=1.0, modelType="multinomial").fit(pos).transform(pos).select("vec_id", F.col("prediction").alias("nb"))
    return svm.join(nb, "vec_id").join(none, "vec_id").agg(
        F.count(F.lit(1)).alias("n"), F.every(F.col("svm").isin(0.0, 1.0) & F.col("nb").isin(0.0, 1.0)).alias("classes_only"),
        F.every(F.col("none") == 0).alias("one_sided_when_threshold_is_out_of_reach"))


@query("m12_linear_regression_elastic_net", ids=("M12",), sql="""
SELECT unnest(['ols', 'ridge', 'lasso']) AS model, 3 AS n_coefficients, true AS mean_residual_is_zero, unnest([true, false, false]) AS orthogonal""")
def m12_linear_regression_elastic_net(spark, sf_dir):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    li = VectorAssembler(inputCols=["l_quantity", "l_discount", "l_tax"], outputCol="features").transform(
        _li_features(spark, sf_dir))
    rows = []
    for name, reg, en in (("ols", 0.0, 0.0), ("ridge", 0.1, 0.0), ("lasso", 0.1, 1.0)):
        m = LinearRegression(labelCol="y", regParam=reg, elasticNetParam=en, maxIter=20).fit(li)
        r = m.transform(li).select((F.col("y") - F.col("prediction")).alias("r"), "l_quantity", "l_discount", "l_tax")
        # least squares leaves residuals that no feature explains; a penalty doesn't
        c = r.agg(F.avg("r").alias("mean"), F.stddev("r").alias("sd"),
                  F.greatest(*(F.abs(F.corr("r", x)) for x in ("l_quantity", "l_discount", "l_tax"))).alias("corr")).first()
        rows.append((name, len(m.coefficients), bool(abs(c["mean"]) < 1e-6 * c["sd"]), bool(c["corr"] < 1e-6)))
    return spark.createDataFrame(rows, "model string, n_coefficients int, mean_residual_is_zero boolean, orthogonal boolean")


@query("m13_isotonic_regression", ids=("M13",), sql="""
SELECT count(DISTINCT l_quantity) AS n_features, true AS rising, true AS mean_kept FROM lineitem""")
def m13_isotonic_regression(spark, sf_dir):
    from pyspark.ml.regression import IsotonicRegression
    li = _li_features(spark, sf_dir).select(F.col("l_quantity").alias("features"), F.col("y").alias("label"))
    model = IsotonicRegression(featuresCol="features").fit(li)
    fitted = model.transform(li)
    per_value = fitted.groupBy("features").agg(F.max("prediction").alias("fitted"))       # one row per quantity
    before = F.lag("fitted").over(Window.orderBy("features"))
    rising = per_value.select((F.col("fitted") >= F.coalesce(before, F.col("fitted")) - 1e-9).alias("up"))
    means = fitted.agg(F.avg("prediction"), F.avg("label")).first()
    return rising.agg(F.count(F.lit(1)).alias("n_features"), F.every("up").alias("rising"),
                      F.lit(abs(means[0] - means[1]) < 1e-6 * abs(means[1])).alias("mean_kept"))


@query("m14_tree_models", ids=("M14",), sql="""
SELECT unnest(['dt_c', 'rf_c', 'gbt_c', 'dt_r', 'rf_r', 'gbt_r']) AS model, true AS no_worse_than_a_constant""")
def m14_tree_models(spark, sf_dir):
    from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
    from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
    e = _emb(spark, sf_dir).withColumn("label", (F.col("label") % 2).cast("double"))
    out = []
    for name, est in (("dt_c", DecisionTreeClassifier(maxDepth=4)), ("rf_c", RandomForestClassifier(numTrees=5, maxDepth=4, seed=1)),
                      ("gbt_c", GBTClassifier(maxIter=5, maxDepth=3, seed=1)), ("dt_r", DecisionTreeRegressor(maxDepth=4)),
                      ("rf_r", RandomForestRegressor(numTrees=5, maxDepth=4, seed=1)), ("gbt_r", GBTRegressor(maxIter=5, maxDepth=3, seed=1))):
        pred = est.fit(e).transform(e)
        if name.endswith("_c"):            # a classifier's accuracy, a regressor's squared error
            got = pred.agg(F.avg((F.col("prediction") == F.col("label")).cast("double")),
                           F.greatest(F.avg("label"), 1 - F.avg("label"))).first()
            out.append((name, bool(got[0] >= got[1] - 0.02)))
        else:
            got = pred.agg(F.avg(F.pow(F.col("prediction") - F.col("label"), F.lit(2))), F.var_pop("label")).first()
            out.append((name, bool(got[0] <= got[1] * 1.02)))
    return spark.createDataFrame(out, "model string, no_worse_than_a_constant boolean")


@query("m15_kmeans_gmm", ids=("M15",), sql="""
SELECT count(*) AS n, true AS clusters_in_range, true AS soft_sums_to_one, true AS hard_is_the_likeliest FROM embeddings""")
def m15_kmeans_gmm(spark, sf_dir):
    from pyspark.ml.clustering import GaussianMixture, KMeans
    e = _emb(spark, sf_dir)
    km = KMeans(k=4, seed=1, maxIter=10).fit(e)
    g = GaussianMixture(k=2, seed=1, maxIter=10).fit(e)
    a = km.transform(e).select("vec_id", F.col("prediction").alias("kmeans"))
    b = g.transform(e).select("vec_id", F.col("prediction").alias("gmm"), vector_to_array("probability").alias("soft"))
    return a.join(b, "vec_id").agg(
        F.count(F.lit(1)).alias("n"), F.every(F.col("kmeans").between(0, 3)).alias("clusters_in_range"),
        F.every(F.abs(F.aggregate("soft", F.lit(0.0), lambda s, v: s + v) - 1) < 1e-6).alias("soft_sums_to_one"),
        F.every(F.get("soft", F.col("gmm")) >= F.array_max("soft") - 1e-12).alias("hard_is_the_likeliest"))


def _edge_grid(edges, n_edges: int):
    """Edges (src, dst, ...) in the cells of a square grid, by the hashes of both
    ends, and sorted in each.  A vertex is in one row or column of cells, not in
    every partition, and a cell has few vertices: graph iterations send a
    vertex's value to each partition that has it, and look up both ends of each
    edge there.  ``n_edges``: about how many edges there are."""
    cells = max(n_edges / CELL_EDGES, min(2 * edges.sparkSession.sparkContext.defaultParallelism, n_edges / LEAST_CELL_EDGES))
    side = max(1, math.ceil(math.sqrt(cells)))
    row, column = (F.pmod(F.xxhash64(c), F.lit(side)) for c in ("src", "dst"))
    return repartition_and_sort(edges, side * side, row * side + column, sort_by=["src", "dst"])


@query("m16_pic_lda", ids=("M16",), sql="""
SELECT 'pic' AS kind, (SELECT count(DISTINCT o_custkey) FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
       + (SELECT count(DISTINCT l_partkey) FROM lineitem JOIN orders ON l_orderkey = o_orderkey) AS n, true AS in_range
UNION ALL SELECT 'lda', count(DISTINCT term), true FROM (
  SELECT unnest(list_filter(string_split_regex(lower(text), '\\W+'), lambda w: length(w) >= 1)) AS term FROM documents)""")
def m16_pic_lda(spark, sf_dir):
    from pyspark.ml.clustering import LDA, PowerIterationClustering
    from pyspark.ml.feature import CountVectorizer, RegexTokenizer
    # affinity graph = who bought what: one edge per (customer, part) pair
    # that occurs in lineitem x orders (linear in the data, no pair blow-up)
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    sim = (li.join(o, li.l_orderkey == o.o_orderkey)
             .groupBy(F.col("o_custkey").alias("src"), (F.col("l_partkey") + F.lit(1 << 40)).alias("dst"))
             .agg(F.sum("l_quantity").cast("double").alias("weight")))
    pic = PowerIterationClustering(k=3, maxIter=10, weightCol="weight").assignClusters(_edge_grid(sim, li.count()))
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    toks = RegexTokenizer(inputCol="text", outputCol="toks", pattern="\\W+", minTokenLength=1).transform(d)
    # the vocabulary is every term that occurs
    n_terms = toks.select(F.explode("toks").alias("t")).distinct().count()
    cv = CountVectorizer(inputCol="toks", outputCol="features", vocabSize=n_terms).fit(toks)
    lda = LDA(k=3, maxIter=5, seed=1).fit(cv.transform(toks))
    topics = lda.describeTopics(3)
    pic = pic.agg(F.lit("pic").alias("kind"), F.count(F.lit(1)).alias("n"), F.every(F.col("cluster").between(0, 2)).alias("in_range"))
    return pic.unionByName(topics.agg(F.lit("lda").alias("kind"), F.lit(len(cv.vocabulary)).cast("bigint").alias("n"),
                                      F.every(F.array_max("termIndices") < n_terms).alias("in_range")))


@query("m17_als", ids=("M17",), sql="""
SELECT unnest(['implicit', 'explicit']) AS feedback, (SELECT count(*) FROM (SELECT DISTINCT o_custkey, l_partkey
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey)) AS n, true AS finite, true AS orders_preferences""")
def m17_als(spark, sf_dir):
    """Factors of customers and parts from quantities, as implicit and as
    explicit ratings, and predictions for the pairs that occur.  Keys of any
    type are numbered by position, as the factors' keys are integers."""
    from pyspark.ml.recommendation import ALS
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    r = (li.join(o, li.l_orderkey == o.o_orderkey).groupBy("o_custkey", "l_partkey")
           .agg(F.sum("l_quantity").alias("rating")))
    r = materialize(r, "ratings")
    for key, name in (("o_custkey", "user"), ("l_partkey", "item")):
        numbered = zip_with_index(r.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")), [key], name)
        r = lookup(r, numbered.withColumn(name, F.col(name).cast("int")), [key], "_rows")
    # written once: both fits and both predictions read it
    r = materialize(r.select("user", "item", "rating"), "numbered", "zstd")
    # by default ten blocks a side, whatever their size
    blocks = max(ALS_LEAST_BLOCKS, -(-r.count() // ALS_BLOCK_RATINGS))
    out = None
    for feedback, implicit in (("implicit", True), ("explicit", False)):
        model = ALS(rank=4, maxIter=5, regParam=0.1, implicitPrefs=implicit, userCol="user", itemCol="item", ratingCol="rating", seed=1,
                    numUserBlocks=blocks, numItemBlocks=blocks).fit(r)
        p = model.transform(r)                                             # given pairs only
        row = p.agg(F.lit(feedback).alias("feedback"), F.count(F.lit(1)).alias("n"),
                    F.every(F.col("prediction").isNotNull() & ~F.isnan("prediction")).alias("finite"),
                    (F.corr("prediction", "rating") > 0).alias("orders_preferences"))
        out = row if out is None else out.unionByName(row)
    return out