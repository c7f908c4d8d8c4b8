"""A custom estimator and model pair with a parameter of its own."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasRawPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F


class _Columns(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasRawPredictionCol, HasMaxIter):
    """Columns and the iteration limit of the untrained classifier."""


class UntrainedClassifier(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Fits a model whose weights are all zero; a template for estimators written in Python."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction",
                 rawPredictionCol="rawPrediction", maxIter=10):
        super().__init__()
        self._setDefault(maxIter=10)
        self._set(**self._input_kwargs)

    def setMaxIter(self, value: int) -> UntrainedClassifier:
        return self._set(maxIter=value)

    def _fit(self, dataset: DataFrame) -> UntrainedModel:
        width = dataset.select(F.size(vector_to_array(self.getFeaturesCol()))).first()
        return self._copyValues(UntrainedModel(weights=[0.0] * (width[0] if width else 0)))


class UntrainedModel(Model, _Columns):
    def __init__(self, weights: list[float] | None = None):
        super().__init__()
        self.weights = weights or []

    def _transform(self, dataset: DataFrame) -> DataFrame:
        margin = F.aggregate(F.zip_with(vector_to_array(self.getFeaturesCol()), F.lit(self.weights), lambda x, w: x * w),
                             F.lit(0.0), lambda a, b: a + b)
        raw = dataset.withColumn("_m", margin)
        return raw.select(*dataset.columns, array_to_vector(F.array(-F.col("_m"), F.col("_m"))).alias(self.getRawPredictionCol()),
                          F.when(F.col("_m") > 0, 1.0).otherwise(0.0).alias(self.getPredictionCol()))
