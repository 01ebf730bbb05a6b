"""Anomaly queries: feature hashing, k-means, streaming scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import anomaly
from quarry.plans import roles
from quarry.plans.registry import query
from quarry.session import shared_dir, stand_in_source
from quarry.sources import results
from quarry.sources.tables import table


KMEANS_K = 150
COLUMNS = ["event_type", "k", "value"]


def _anomaly_model(spark, d):
    """Hasher, slicer and k-means model.  The saved model's folder is named by
    a fingerprint of the rows, so other data is never scored with it; features
    are made only when it has to be fitted."""
    from pyspark.ml.clustering import KMeansModel
    from pyspark.ml.feature import VectorSlicer
    ev = roles.network_records(table(spark, d, "events"))
    h = anomaly.hasher(COLUMNS)
    mark = ev.agg(F.count(F.lit(1)), F.expr(f"bit_xor(xxhash64({', '.join(COLUMNS)}))"),
                  F.expr(f"sum(cast(xxhash64({', '.join(COLUMNS)}) as decimal(38,0)))")).first()
    key = f"{KMEANS_K}-" + "-".join(map(str, mark))
    cut = results.load_or_fit(spark, "entries", key, VectorSlicer,
                              lambda: anomaly.slicer(anomaly.used_entries(h.transform(ev))))
    model = results.load_or_fit(spark, "kmeans", key, KMeansModel, lambda: anomaly.fit_kmeans(
        cut.transform(h.transform(ev)).select("used").checkpoint(), KMEANS_K, 1))
    return h, cut, model


@query("hash_features")
def hash_features(spark, d):
    x = anomaly.hasher(COLUMNS).transform(roles.network_records(table(spark, d, "events")))
    x = x.select("event_id", anomaly.entries().alias("e"))
    return x.select("event_id", F.size(F.filter("e", lambda e: e["v"] != 0)).alias("nnz"),
                    F.round(F.aggregate("e", F.lit(0.0), lambda s, e: s + e["v"]), 4).alias("total"))


@query("kmeans_assign")
def kmeans_assign(spark, d):
    h, cut, model = _anomaly_model(spark, d)
    ev = roles.network_records(table(spark, d, "events"))
    s = anomaly.score(model, cut.transform(h.transform(ev)))
    return s.select("event_id", "cluster", F.round("distance", 6).alias("distance"))


@query("anomaly_stream")
def anomaly_stream(spark, d):
    """Events replayed as a file stream (several Parquet files), scored by the
    batch-fitted model, written to a Parquet sink and read back."""
    from quarry.streaming.anomaly_stream import run_scoring_stream
    h, cut, model = _anomaly_model(spark, d)
    ev = table(spark, d, "events")
    src = stand_in_source(spark, "events-src", d,
                          lambda p: ev.repartition(8, "event_id").write.mode("overwrite").parquet(p))
    sink = run_scoring_stream(spark, src, ev.schema, roles.network_records, [h, cut], model,
                              shared_dir(spark, "scored"),
                              shared_dir(spark, "scored-ckpt"), files_per_trigger=2)
    out = spark.read.parquet(sink)
    return out.select("event_id", "cluster", F.round("distance", 6).alias("distance"))
