"""Classification: one-hot decoding, class priors, random-guess baseline,
decision trees / forests / logistic regression with confusion metrics.

Trees come from ``trees``, other models from ``pyspark.ml``; the evaluation pieces (priors, confusion,
precision / recall) are plain aggregations over (label, prediction).
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.trees import TreeClassifier


def decode_onehot(df: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """Replace each group of 0/1 flag columns by the 0-based index of its set
    flag (NULL when none is set)."""
    out = df
    for name, cols in groups.items():
        pos = F.array_position(F.array(*[F.col(c).cast("double") for c in cols]), F.lit(1.0))
        out = out.withColumn(name, F.when(pos > 0, (pos - 1).cast("int"))).drop(*cols)
    return out


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


def array_features(df: DataFrame, col: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(col)))


def class_priors(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, prior): class share of the rows; the total is a scalar subquery."""
    n = df.select(F.count(F.lit(1)).cast("double")).scalar()
    return df.groupBy(label).agg((F.count(F.lit(1)) / n).alias("prior"))


def random_guess_accuracy(train: DataFrame, cv: DataFrame, label: str = "label") -> DataFrame:
    """Accuracy of guessing classes at the training priors: sum p_train * p_cv."""
    a = class_priors(train, label).withColumnRenamed("prior", "p_train")
    b = class_priors(cv, label).withColumnRenamed("prior", "p_cv")
    return a.join(b, label).agg(F.sum(F.col("p_train") * F.col("p_cv")).alias("accuracy"))


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return pred.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("cnt"))


def precision_recall(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class: precision = TP / predicted, recall = TP / actual (NULL if 0)."""
    c = confusion(pred, label, prediction)
    tp = c.where(F.col(label) == F.col(prediction)).select(F.col(label).alias("cls"), F.col("cnt").alias("tp"))
    actual = c.groupBy(F.col(label).alias("cls")).agg(F.sum("cnt").alias("actual"))
    predicted = c.groupBy(F.col(prediction).alias("cls")).agg(F.sum("cnt").alias("predicted"))
    x = actual.join(predicted, "cls", "full").join(tp, "cls", "left").na.fill(0, ["tp", "actual", "predicted"])
    return x.select("cls", (F.col("tp") / F.nullif(F.col("predicted"), F.lit(0))).alias("precision"),
                    (F.col("tp") / F.nullif(F.col("actual"), F.lit(0))).alias("recall"))


def accuracy(label: str = "label", prediction: str = "prediction") -> F.Column:
    return F.avg((F.col(label) == F.col(prediction)).cast("double"))


def tree(impurity: str = "gini", depth: int = 4, bins: int = 100, seed: int = 1) -> TreeClassifier:
    return TreeClassifier(impurity, depth, bins, seed)


def forest(trees: int = 20, impurity: str = "entropy", depth: int = 30, bins: int = 300,
           seed: int = 1) -> TreeClassifier:
    return TreeClassifier(impurity, depth, bins, seed, trees=trees)


def logreg(max_iter: int = 10, reg: float = 0.3, elastic: float = 0.8) -> LogisticRegression:
    return LogisticRegression(maxIter=max_iter, regParam=reg, elasticNetParam=elastic)


def grid_eval(train: DataFrame, cv: DataFrame, grid: list[dict], make, parallelism: int = 4) -> DataFrame:
    """Fit one model per parameter set, score train and validation accuracy;
    rows ordered by validation accuracy (desc).  Fits run as concurrent Spark
    jobs from ``parallelism`` driver threads (as ML tuning's ``parallelism``)."""
    from concurrent.futures import ThreadPoolExecutor
    spark = train.sparkSession
    train, cv = train.select("label", "features"), cv.select("label", "features")

    def one(params):
        m = make(**params).fit(train)
        tr = m.transform(train).agg(accuracy().alias("a")).first()["a"]
        va = m.transform(cv).agg(accuracy().alias("a")).first()["a"]
        return (str(sorted(params.items())), float(tr), float(va))

    with ThreadPoolExecutor(max_workers=parallelism) as ex:
        rows = list(ex.map(one, grid))
    df = spark.createDataFrame(rows, "params string, train_accuracy double, cv_accuracy double")
    return df.orderBy(F.col("cv_accuracy").desc(), "params")


def refit_score(train: DataFrame, cv: DataFrame, test: DataFrame, model, label: str) -> DataFrame:
    """Refit one chosen model on train + cv (union by name) and score it on
    the held-out test split and on the data it was fitted on."""
    both, test = train.unionByName(cv).select("label", "features"), test.select("label", "features")
    m = model.fit(both)
    fit_acc = m.transform(both).agg(accuracy().alias("a")).first()["a"]
    test_acc = m.transform(test).agg(accuracy().alias("a")).first()["a"]
    return train.sparkSession.createDataFrame(
        [(label, float(fit_acc), float(test_acc))], "params string, train_accuracy double, cv_accuracy double")
