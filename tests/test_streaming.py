"""Stream = batch: the file-source scoring stream returns what the batch
scorer returns for the same events and the same (loaded) model."""
import __spark_entry__ as entry

from conftest import SMOKE


def test_stream_equals_batch(spark):
    qs = entry.queries()
    batch = qs["kmeans_assign"](spark, SMOKE)        # fits and saves the model
    stream = qs["anomaly_stream"](spark, SMOKE)      # loads it, scores file by file
    b = sorted(tuple(r) for r in batch.collect())
    s = sorted(tuple(r) for r in stream.select(*batch.columns).collect())
    assert len(b) == len(s) > 0
    assert b == s


def test_processing_time_trigger_equals_batch(spark):
    from quarry.plans import roles
    from quarry.plans.queries.anomaly import _anomaly_model
    from quarry.operators import anomaly
    from quarry.session import shared_dir
    from quarry.sources.tables import table
    from quarry.streaming.anomaly_stream import start_scoring_stream
    h, cut, model = _anomaly_model(spark, SMOKE)
    ev = table(spark, SMOKE, "events")
    src = shared_dir(spark, "t-src")
    ev.repartition(4, "event_id").write.parquet(src)
    sink = shared_dir(spark, "t-sink")
    q = start_scoring_stream(spark, src, ev.schema, roles.network_records, [h, cut], model,
                             sink, shared_dir(spark, "t-ckpt"),
                             files_per_trigger=1, trigger={"processingTime": "1 second"})
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    s = spark.read.parquet(sink).select("event_id", "cluster")
    feats = cut.transform(h.transform(roles.network_records(ev)))
    b = anomaly.score(model, feats).select("event_id", "cluster")
    assert sorted(map(tuple, s.collect())) == sorted(map(tuple, b.collect()))


def test_restart_from_checkpoint_is_exactly_once(spark):
    from pyspark.sql import functions as F
    from quarry.plans import roles
    from quarry.plans.queries.anomaly import _anomaly_model
    from quarry.session import shared_dir
    from quarry.sources.tables import table
    from quarry.streaming.anomaly_stream import run_scoring_stream
    h, cut, model = _anomaly_model(spark, SMOKE)
    ev = table(spark, SMOKE, "events")
    src, sink, ckpt = shared_dir(spark, "r-src"), shared_dir(spark, "r-sink"), shared_dir(spark, "r-ckpt")
    ev.where(F.col("event_id") % 2 == 0).repartition(2).write.parquet(src)
    run_scoring_stream(spark, src, ev.schema, roles.network_records, [h, cut], model, sink, ckpt)
    # more input arrives; the restarted query (same checkpoint) picks up only the new files
    ev.where(F.col("event_id") % 2 == 1).repartition(2).write.mode("append").parquet(src)
    run_scoring_stream(spark, src, ev.schema, roles.network_records, [h, cut], model, sink, ckpt)
    ids = [r.event_id for r in spark.read.parquet(sink).select("event_id").collect()]
    assert len(ids) == len(set(ids)) == ev.count()
