"""The engine's own fits as pipeline stages: population standardisation and
the network regression, each an ``Estimator`` and a ``Model`` with params,
usable in pipelines and cross-validators, saved and loaded.

What a model has learned is kept in params of its own (a few numbers per
input or weight), so the library's params writer saves all of it.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasMaxIter, HasOutputCols, HasPredictionCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.operators.cv import add_prediction
from kiln.operators.layers import layer_sizes
from kiln.operators.mlp import fit_mlp


def _floats(owner: str, name: str, doc: str) -> Param:
    return Param(owner, name, doc, typeConverter=TypeConverters.toListFloat)


class PopulationScaler(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Standardises columns by mean and population deviation; a constant
    column becomes 0, NULL stays NULL and doesn't count."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> PopulationScalerModel:
        cols = self.getInputCols()
        row = dataset.agg(*(F.coalesce(f(F.col(c).cast("double")), F.lit(0.0)) for f in (F.avg, F.stddev_pop) for c in cols)).first()
        model = PopulationScalerModel(means=list(row[:len(cols)]), deviations=list(row[len(cols):]))
        return self._copyValues(model)


class PopulationScalerModel(Model, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    means = _floats(Params._dummy(), "means", "mean of each input")
    deviations = _floats(Params._dummy(), "deviations", "population deviation of each input")

    @keyword_only
    def __init__(self, *, means: list[float] | None = None, deviations: list[float] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = {}
        for c, to, mean, dev in zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault(self.means), self.getOrDefault(self.deviations)):
            x = F.col(c).cast("double")
            out[to] = F.when(x.isNotNull(), F.lit(0.0)) if dev == 0 else (x - mean) / dev
        return dataset.withColumns(out)


class _NetworkParams(HasInputCols, HasLabelCol, HasPredictionCol):
    hidden = Param(Params._dummy(), "hidden", "units of each hidden layer", typeConverter=TypeConverters.toListInt)


class MlpRegressor(Estimator, _NetworkParams, HasMaxIter, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Network regression by scaled conjugate gradient (``fit_mlp``): inputs
    and label are standardised on the training rows, every step is a Spark
    job over all of them.  Rows that lack a value don't count."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, labelCol: str = "label", predictionCol: str = "prediction",
                 hidden: list[int] | None = None, maxIter: int = 100, seed: int = 0):
        super().__init__()
        self._setDefault(labelCol="label", predictionCol="prediction", hidden=[10], maxIter=100, seed=0)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> MlpRegressionModel:
        inputs, label = self.getInputCols(), self.getLabelCol()
        cols = [*inputs, label]
        rows = dataset.select(F.lit(0).alias("bucket"), F.lit(0).alias("fold"), *(F.col(c).cast("double").alias(c) for c in cols)).na.drop()
        s = rows.agg(F.count(F.lit(1)), *(f(c) for f in (F.avg, F.stddev_pop) for c in cols)).first()
        if not s[0]:
            raise ValueError("no row has all inputs and the label")
        means, devs = [float(v) for v in s[1:1 + len(cols)]], [float(v) for v in s[1 + len(cols):]]
        one = dataset.sparkSession.createDataFrame(
            [(0, 1, 2, s[0], means[:-1], devs[:-1], means[-1], devs[-1])],
            "bucket int, test_fold int, val_fold int, n_train bigint, x_mean array<double>, x_std array<double>, t_mean double, t_std double")
        _, _, fitted = fit_mlp(rows, one, inputs, label, self.getOrDefault(self.hidden), self.getMaxIter(), seed=self.getSeed())
        model = MlpRegressionModel(weights=[float(v) for v in fitted.w[0]], means=means, deviations=devs,
                                   losses=[float(v) for v in fitted.traces[0]])
        return self._copyValues(model)


class MlpRegressionModel(Model, _NetworkParams, DefaultParamsReadable, DefaultParamsWritable):
    """Scores in the JVM, one projection per layer."""
    weights = _floats(Params._dummy(), "weights", "weights, layer by layer")
    means = _floats(Params._dummy(), "means", "means of the inputs, then the label")
    deviations = _floats(Params._dummy(), "deviations", "population deviations of the inputs, then the label")
    losses = _floats(Params._dummy(), "losses", "training loss before the first step and after each")

    @keyword_only
    def __init__(self, *, weights: list[float] | None = None, means: list[float] | None = None, deviations: list[float] | None = None,
                 losses: list[float] | None = None):
        super().__init__()
        self._setDefault(labelCol="label", predictionCol="prediction", hidden=[10])
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        inputs = self.getInputCols()
        means, devs = self.getOrDefault(self.means), self.getOrDefault(self.deviations)
        named = dataset.select(
            F.struct("*").alias("_row"), *(F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(inputs)),
            F.array(*map(F.lit, means[:-1])).alias("x_mean"), F.array(*map(F.lit, devs[:-1])).alias("x_std"),
            F.lit(means[-1]).alias("t_mean"), F.lit(devs[-1]).alias("t_std"))
        sizes = layer_sizes(len(inputs), self.getOrDefault(self.hidden), 1)
        scored = add_prediction(named, [f"_x{i}" for i in range(len(inputs))], sizes, self.getOrDefault(self.weights), out="_yhat")
        return scored.select("_row.*", F.col("_yhat").alias(self.getPredictionCol()))
