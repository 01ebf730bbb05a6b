"""Structured Streaming scoring of events with a fitted hasher + k-means.

Source: a folder of Parquet files read with ``readStream`` (``maxFilesPerTrigger``
files per micro-batch); sink: Parquet, a folder per micro-batch that a repeated
batch overwrites, with a checkpoint location, both in the shared folder, so a
restarted query resumes where it stopped and writes each row once.  Every
micro-batch is scored by the batch operator, so stream output equals batch
output; the centres' index is made once.
"""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quarry.operators.anomaly import centre_postings, score


def start_scoring_stream(spark: SparkSession, source: str, schema: T.StructType, prepare,
                         featurizers: list[Transformer], model: KMeansModel,
                         sink: str, checkpoint: str, files_per_trigger: int = 1,
                         trigger: dict | None = None) -> StreamingQuery:
    """Start the scoring stream and return the running query.  ``trigger`` is
    passed to ``DataStreamWriter.trigger`` (default: 1-second micro-batches)."""
    raw = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
           .parquet(source))
    centres = centre_postings(model)

    def one(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch)
        for f in featurizers:
            rows = f.transform(rows)
        score(model, rows, centres).drop("features").write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
    w = raw.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "1 second"})).start()


def run_scoring_stream(spark: SparkSession, source: str, schema: T.StructType, prepare,
                       featurizers: list[Transformer], model: KMeansModel,
                       sink: str, checkpoint: str, files_per_trigger: int = 1) -> str:
    """Score everything currently in ``source`` (``availableNow``: several
    micro-batches, then stop) and return the sink path."""
    q = start_scoring_stream(spark, source, schema, prepare, featurizers, model, sink,
                             checkpoint, files_per_trigger, {"availableNow": True})
    q.awaitTermination()
    return sink
