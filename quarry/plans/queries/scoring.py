"""Embedding-pipeline queries: featurizer + LR, worst predictions, top classes, SQL UDFs."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.expr import hash_uniform
from quarry.operators import classify, scoring
from quarry.plans.registry import query
from quarry.session import stand_in_source
from quarry.sources import files
from quarry.sources.tables import table


def _class_folders(spark, d):
    """The embeddings as files in a folder per class: labels of 5 and more,
    and the others."""
    e = table(spark, d, "embeddings", "vec_id", "embedding", "label")
    kind = F.when(F.col("label") >= 5, "high").otherwise("low").alias("kind")
    return stand_in_source(spark, "classes", d, lambda root: e.select("vec_id", "embedding", kind)
                           .write.mode("overwrite").partitionBy("kind").parquet(root))


def _labelled(spark, d):
    """One frame: the class is its folder's, ``is_train`` a hash draw of 60 %."""
    x = spark.read.parquet(_class_folders(spark, d))
    return x.select("vec_id", "embedding", (F.col("kind") == "high").cast("double").alias("label"),
                    (hash_uniform(F.col("vec_id"), F.lit("img")) < 0.6).alias("is_train"))


@query("image_files")
def image_files(spark, d):
    """binaryFile scan of the class folders: path, length, label from the folder."""
    b = files.read_binary(spark, _class_folders(spark, d), "*.parquet")
    return b.select("path", "length", F.col("path").contains("/kind=high/").cast("int").alias("label"))


def _fitted(spark, d):
    x = _labelled(spark, d)
    model = scoring.feature_lr_pipeline(1, 0.05, 0.3).fit(x.where("is_train"))
    return model, model.transform(x.where("not is_train"))


@query("embed_pipeline")
def embed_pipeline(spark, d):
    """Pipeline (featurizer + LR, 1 iteration, reg 0.05, alpha 0.3): test accuracy."""
    _, pred = _fitted(spark, d)
    return pred.agg(classify.accuracy().alias("accuracy"))


@query("worst_predictions")
def worst_predictions(spark, d):
    _, pred = _fitted(spark, d)
    return scoring.worst_predictions(pred, 10)


@query("topk_classes")
def topk_classes(spark, d):
    """Ten most probable of the ten classes per embedding (multinomial LR)."""
    e = table(spark, d, "embeddings", "vec_id", "embedding", "label") \
        .withColumn("label", F.col("label").cast("double"))
    m = scoring.feature_lr_pipeline(10, 0.01, 0.0).fit(e)
    return scoring.top_classes(m.transform(e), 10)


@query("sql_model_udf")
def sql_model_udf(spark, d):
    """Two fitted models registered as SQL functions and called from SQL."""
    e = table(spark, d, "embeddings", "vec_id", "embedding", "label") \
        .withColumn("label", F.col("label").cast("double"))
    for name, reg in (("class_weak_penalty", 0.01), ("class_strong_penalty", 0.1)):
        lr = scoring.feature_lr_pipeline(10, reg, 0.0).fit(e).stages[-1]
        scoring.register_linear_model_udf(spark, name, lr.coefficientMatrix.toArray(),
                                          lr.interceptVector.toArray())
    e.createOrReplaceTempView("labelled_vectors")
    return spark.sql("""
        SELECT vec_id, int(label) AS label, class_weak_penalty(embedding) AS weak_prediction,
               class_strong_penalty(embedding) AS strong_prediction
        FROM labelled_vectors""")
