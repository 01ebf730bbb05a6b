"""Network anomaly detection: typed feature hashing, k-means, distance to the
assigned centre (batch; the streaming job reuses these transforms).

Hashed vectors stay sparse: a row has a few non-zero entries of 2^18.  The
model is fitted on the entries that occur at all - the others are 0 in every
row and centre, so clusters and distances are those of the full space.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import FeatureHasher, VectorSlicer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hasher(cols: list[str], num_features: int = 1 << 18, categorical: list[str] | None = None) -> FeatureHasher:
    """Hash all columns into one sparse vector; numeric columns keep their
    value (hashed by name), strings are one-hot by value."""
    return FeatureHasher(inputCols=cols, outputCol="features", numFeatures=num_features,
                         categoricalCols=categorical or [])


def entries(vector: str = "features") -> Column:
    """A vector's stored entries as array<struct<indices, values>>."""
    v = F.unwrap_udt(vector)
    at = F.when(v["type"] == 0, v["indices"]).otherwise(F.sequence(F.lit(0), F.size(v["values"]) - 1))
    return F.when(F.size(v["values"]) > 0, F.arrays_zip(at.alias("i"), v["values"].alias("v"))).otherwise(
        F.array().cast("array<struct<i:int,v:double>>"))


def used_entries(featurized: DataFrame) -> list[int]:
    """Indices of the entries that are not 0 in some row: at most the
    hasher's ``num_features``, whatever the number of rows."""
    e = featurized.select(F.explode(entries()).alias("e")).where("e.v <> 0").select(F.col("e.i").alias("i")).distinct()
    return sorted(r["i"] for r in e.collect())


def slicer(indices: list[int]) -> VectorSlicer:
    return VectorSlicer(inputCol="features", outputCol="used", indices=indices)


def fit_kmeans(featurized: DataFrame, k: int = 150, seed: int = 1, max_iter: int = 20) -> KMeansModel:
    """k-means on the sliced vectors (column ``used``)."""
    return KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="used").fit(featurized)


def centre_postings(model: KMeansModel) -> tuple[DataFrame, DataFrame]:
    """The fitted centres as tables in the shared folder: an inverted index
    (i, cluster, weight) of their entries that are not 0, and (cluster, norm),
    the squared norms."""
    import numpy as np
    import pandas as pd
    from pyspark.sql import SparkSession

    from quarry.session import shared_dir
    spark = SparkSession.getActiveSession()
    c = np.array(model.clusterCenters())
    at = np.nonzero(c)
    tables = []
    for name, data, schema in (
            ("postings", {"i": at[1], "cluster": at[0], "weight": c[at]}, "i int, cluster int, weight double"),
            ("norms", {"cluster": np.arange(len(c)), "norm": (c * c).sum(axis=1)}, "cluster int, norm double")):
        path = shared_dir(spark, f"centre-{name}")
        spark.createDataFrame(pd.DataFrame(data), schema).write.parquet(path)
        tables.append(spark.read.schema(schema).parquet(path))
    return tables[0], tables[1]


def score(model: KMeansModel, featurized: DataFrame, centres: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Assign each row to a cluster and add the Euclidean distance to its
    centre: |c|^2 plus v (v - 2 c[i]) over the row's entries.  The entries are
    looked up in the inverted index of the centres (``centre_postings``) and
    added up per row, so the plan does not grow with clusters or entries; the
    index is broadcast or shuffled by its size at run time.  Not for a
    streaming frame itself: score its micro-batches."""
    postings, norms = centres or centre_postings(model)
    p = model.transform(featurized).withColumnRenamed("prediction", "cluster")
    keep = [c for c in p.columns if c != "used"]
    rows = p.select(F.monotonically_increasing_id().alias("_row"), F.struct(*keep).alias("_all"), "cluster",
                    entries("used").alias("e"))  # numbered before its entries are dealt out
    rows = rows.select("_row", "_all", "cluster", F.explode_outer("e").alias("e"))
    rows = rows.select("_row", "_all", "cluster", F.col("e.i").alias("i"), F.coalesce("e.v", F.lit(0.0)).alias("v"))
    part = F.col("v") * (F.col("v") - 2 * F.coalesce("weight", F.lit(0.0)))
    moved = (rows.join(postings, ["i", "cluster"], "left")
             .groupBy("_row").agg(F.sum(part).alias("_moved"), F.first("_all").alias("_all")).select("_moved", "_all.*"))
    return moved.join(norms, "cluster").select(
        *keep, F.sqrt(F.greatest(F.lit(0.0), F.col("norm") + F.col("_moved"))).alias("distance"))
