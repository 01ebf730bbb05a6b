"""Image-style classification on ready-made feature vectors: a feature +
logistic-regression pipeline, worst predictions, top-k classes per row, and a
fitted model exposed as a SQL function (vectorised pandas UDF)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ArrayToVector(Transformer, HasInputCol, HasOutputCol):
    """Featurizer stage: array<float> column -> ML vector (a native column
    expression; the stage only names the columns)."""

    def __init__(self, inputCol: str = "embedding", outputCol: str = "features"):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOutputCol(), array_to_vector(F.col(self.getInputCol())))


def feature_lr_pipeline(max_iter: int = 1, reg: float = 0.05, elastic: float = 0.3,
                        source: str = "embedding") -> Pipeline:
    """Featurizer (array -> vector, as a SQL stage) followed by logistic regression."""
    feat = ArrayToVector(source, "features")
    lr = LogisticRegression(maxIter=max_iter, regParam=reg, elasticNetParam=elastic, labelCol="label")
    return Pipeline(stages=[feat, lr])


def positive_probability(pred: DataFrame) -> DataFrame:
    """p_1 = probability of class 1, as a native column (no Python UDF)."""
    return pred.withColumn("p_1", vector_to_array("probability")[1])


def worst_predictions(pred: DataFrame, n: int = 10, key: str = "vec_id") -> DataFrame:
    """The n rows whose p_1 is furthest from the label (a top-n report)."""
    p = positive_probability(pred)
    return (p.orderBy(F.abs(F.col("p_1") - F.col("label")).desc(), F.col(key).asc())
            .limit(n).select(key, "p_1", "label"))


def top_classes(pred: DataFrame, k: int = 10, key: str = "vec_id") -> DataFrame:
    """Per row, the k most probable classes with their probabilities: each
    row's class list is sorted in place, nothing is shuffled."""
    ranked = F.array_sort(F.transform(vector_to_array("probability"), lambda p, i: F.struct(
        (-p).alias("neg"), i.alias("cls"), p.alias("prob"))))
    x = pred.select(key, F.posexplode(F.slice(ranked, 1, k)).alias("place", "c"))
    return x.select(key, F.col("c.cls").alias("cls"), F.col("c.prob").alias("prob"), (F.col("place") + 1).alias("rank"))


def register_linear_model_udf(spark: SparkSession, name: str, coef: np.ndarray,
                              intercept: np.ndarray) -> None:
    """Register ``name(array<float>) -> int``: argmax of W x + b, evaluated on
    Arrow batches.  The model (classes x features) travels in the closure,
    bounded by its size."""
    w = np.asarray(coef, dtype=float)
    b = np.asarray(intercept, dtype=float)

    @F.pandas_udf(T.IntegerType())
    def predict(x: pd.Series) -> pd.Series:
        m = np.vstack(x.to_numpy()).astype(float)
        return pd.Series(np.argmax(m @ w.T + b, axis=1).astype("int32"))

    spark.udf.register(name, predict)
