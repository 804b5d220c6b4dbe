"""Model persistence and the cross-validator behaviour."""

from __future__ import annotations

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from kiln.operators.estimators import MlpRegressor, PopulationScaler
from kiln.session import materialize, scratch_path
from kiln.sources.tables import table

from kiln_cases import SF_SMALL


def test_model_save_load_round_trip(spark):
    df = spark.range(200).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2.0 + 1).alias("label"))
    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    m = LinearRegression(maxIter=10).fit(data)
    path = scratch_path(spark, "model")
    m.write().overwrite().save(path)
    back = LinearRegressionModel.load(path)
    assert abs(back.coefficients[0] - 2.0) < 1e-6 and abs(back.intercept - 1.0) < 1e-6


def test_cross_validator_picks_zero_error_setting(spark):
    # label == feature exactly: the unregularised fit has zero error
    df = spark.range(40).select(F.col("id").cast("double").alias("feature")).withColumn("label", F.col("feature"))
    data = VectorAssembler(inputCols=["feature"], outputCol="features").transform(df)
    lr = LinearRegression()
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.0, 10.0]).build()
    cv = CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=RegressionEvaluator(), numFolds=3, seed=1)
    model = cv.fit(data)
    assert model.avgMetrics[0] < 1e-6 < model.avgMetrics[1]


def _wave(spark, n=600):
    x = F.pmod(F.xxhash64("id"), F.lit(1000)) / 500.0 - 1
    return (spark.range(n).select("id", x.alias("a"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 1000.0).alias("b"), F.lit(3.0).alias("same"))
            .withColumn("y", 5 + F.sin(3 * F.col("a")) * 2 + F.col("b")))


def test_own_estimators_in_a_pipeline_saved_and_loaded(spark):
    data = _wave(spark)
    stages = [PopulationScaler(inputCols=["a", "same"], outputCols=["a_std", "same_std"]),
              MlpRegressor(inputCols=["a_std", "b", "same_std"], labelCol="y", predictionCol="yhat", hidden=[6], maxIter=40, seed=2)]
    fitted = Pipeline(stages=stages).fit(data)
    scored = fitted.transform(data)
    assert scored.columns == [*data.columns, "a_std", "same_std", "yhat"]
    m = scored.agg(F.avg("a_std"), F.stddev_pop("a_std"), F.max("same_std"), F.avg(F.pow(F.col("yhat") - F.col("y"), 2)), F.var_pop("y")).first()
    assert abs(m[0]) < 1e-9 and abs(m[1] - 1) < 1e-9 and m[2] == 0 and m[3] < 0.1 * m[4]
    path = scratch_path(spark, "pipeline")
    fitted.save(path)
    again = PipelineModel.load(path).transform(data)
    assert again.join(scored.select("id", F.col("yhat").alias("z")), "id").where("yhat <> z").count() == 0
    plain = scratch_path(spark, "estimator")
    stages[1].save(plain)
    assert MlpRegressor.load(plain).getOrDefault("hidden") == [6] and fitted.stages[1].getOrDefault("losses")[-1] < 0.1


def test_own_estimator_in_a_cross_validator(spark):
    data = _wave(spark, 300)
    net = MlpRegressor(inputCols=["a", "b"], labelCol="y", maxIter=15, seed=1)
    grid = ParamGridBuilder().addGrid(net.hidden, [[4]]).addGrid(net.maxIter, [1, 15]).build()
    cv = CrossValidator(estimator=net, estimatorParamMaps=grid, evaluator=RegressionEvaluator(labelCol="y"), numFolds=2, seed=3)
    model = cv.fit(data)
    assert model.avgMetrics[1] < model.avgMetrics[0] and model.bestModel.transform(data).count() == 300


def test_own_estimators_and_missing_values(spark):
    data = spark.createDataFrame([(1.0, 2.0), (None, 3.0), (3.0, None)], "x double, y double")
    scaled = PopulationScaler(inputCols=["x"], outputCols=["z"]).fit(data).transform(data)
    assert [r.z for r in scaled.collect()] == [-1.0, None, 1.0]
    none = PopulationScaler(inputCols=["x"], outputCols=["z"]).fit(data.limit(0))
    assert none.getOrDefault("means") == [0.0]
    with pytest.raises(ValueError, match="no row"):
        MlpRegressor(inputCols=["x"], labelCol="y").fit(data.where("x is null"))


def test_word2vec_tasks_grow_with_the_texts(spark, monkeypatch):
    """One task would train on all texts, however many."""
    from pyspark.ml import feature

    from kiln.plans import ml_plans
    asked, fit = [], feature.Word2Vec._fit

    def seen(self, dataset):
        asked.append(self.getNumPartitions())
        return fit(self, dataset)

    monkeypatch.setattr(feature.Word2Vec, "_fit", seen)
    size = table(spark, SF_SMALL, "documents").selectExpr("sum(octet_length(text))").first()[0]
    monkeypatch.setattr(ml_plans, "WORD2VEC_BYTES", size // 3 + 1)
    row = ml_plans.m9_word2vec_synonyms(spark, SF_SMALL).first()
    assert asked == [3] and tuple(row) == (5, True, True)


@pytest.mark.parametrize("id_bytes", [0, 1 << 20])
def test_exact_tf_idf_meets_rows_of_an_id(spark, monkeypatch, tmp_path, id_bytes):
    """Repeated and missing ids, whether rows of an id meet before or after the split."""
    import math
    from collections import Counter

    from kiln.plans import ml_plans
    monkeypatch.setattr(ml_plans, "ID_BYTES", max(1, id_bytes))
    rows = [(1, "a b a"), (1, "A c"), (None, "b b"), (None, "d"), (2, None), (3, "!"), (4, "c d e")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    tf = Counter((d, w) for d, t in rows for w in (t or "").lower().replace("!", "").split())
    df = Counter(w for _, w in tf)
    want = {d: [(n * math.log((len(rows) + 1) / (df[w] + 1))) for (e, w), n in tf.items() if e == d] for d, _ in tf}
    got = ml_plans.m6_exact_tf_idf(spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.n_terms, r.tfidf_sum) for r in got} == {d: (len(v), round(sum(v), 4)) for d, v in want.items()}


def test_als_computes_its_ratings_once(spark, monkeypatch):
    """Fits and predictions read the numbered ratings as written, without the joins before."""
    from kiln.plans import ml_plans
    written = []
    monkeypatch.setattr(ml_plans, "materialize", lambda df, name="cut", *a: written.append((name, df.columns)) or materialize(df, name, *a))
    got = ml_plans.m17_als(spark, SF_SMALL).collect()
    assert ("numbered", ["user", "item", "rating"]) in written and all(r.finite for r in got)


def test_a_vertex_is_in_few_partitions_of_a_graph(spark, monkeypatch):
    """Power iteration gets its edges in a grid by both ends; a vertex was in all partitions."""
    from pyspark.ml.clustering import PowerIterationClustering

    from kiln.plans import ml_plans
    seen, assign = [], PowerIterationClustering.assignClusters
    monkeypatch.setattr(PowerIterationClustering, "assignClusters", lambda self, edges: seen.append(edges) or assign(self, edges))
    monkeypatch.setattr(ml_plans, "CELL_EDGES", 400)
    assert {r.kind: r.in_range for r in ml_plans.m16_pic_lda(spark, SF_SMALL).collect()} == {"pic": True, "lda": True}
    cells = seen[0].rdd.glom().collect()
    n = sum(map(len, cells))
    side = round(len(cells) ** 0.5)
    assert side * side == len(cells) and side >= 3 and max(map(len, cells)) < 3 * n / len(cells)
    assert all(cell == sorted(cell, key=lambda e: (e.src, e.dst)) for cell in cells)
    for end in ("src", "dst"):
        of_vertex = {}
        for i, cell in enumerate(cells):
            for e in cell:
                of_vertex.setdefault(e[end], set()).add(i)
        assert max(map(len, of_vertex.values())) <= side
    want = (table(spark, SF_SMALL, "lineitem").join(table(spark, SF_SMALL, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .agg(F.count_distinct("o_custkey", "l_partkey"), F.sum("l_quantity")).first())
    assert (n, sum(e.weight for cell in cells for e in cell)) == (want[0], pytest.approx(want[1]))


def test_blocks_of_a_factorization_follow_the_ratings(spark, monkeypatch):
    """Ten blocks a side hold a tenth of all ratings each, whatever their number."""
    from pyspark.ml.recommendation import ALS

    from kiln.plans import ml_plans
    used, fit = [], ALS.fit
    monkeypatch.setattr(ALS, "fit", lambda self, r: used.append((self.getNumUserBlocks(), self.getNumItemBlocks())) or fit(self, r))
    as_rows = [(r.feedback, r.n, r.finite, r.orders_preferences) for r in ml_plans.m17_als(spark, SF_SMALL).collect()]
    assert used == [(10, 10)] * 2
    n = as_rows[0][1]
    monkeypatch.setattr(ml_plans, "ALS_BLOCK_RATINGS", n // 12)
    assert [(r.feedback, r.n, r.finite, r.orders_preferences) for r in ml_plans.m17_als(spark, SF_SMALL).collect()] == as_rows
    assert used[2:] == [(-(-n // (n // 12)),) * 2] * 2 and used[2][0] > 10
