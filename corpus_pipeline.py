"""A training-data pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept, and returns a DataFrame; all but the last return the columns of
``documents``.  ``run`` writes each stage's rows as Parquet to the shared
folder and reads them back for the next.

1. toxicity - documents that the boosted trees score 0.3 or more go.
2. near_duplicates - of each group of texts linked by n-gram Jaccard similarity
   (five words, 0.8) one row of the smallest id stays.  Rows that share an id
   are grouped by their texts alone.  Rows with a null id, and texts without
   words, stay.
3. decontaminate - documents that hold ten consecutive words of a benchmark
   item (or the whole of a shorter item) go.
4. pii - spans of personal data are replaced by their kind; ``n_chars``, where
   present, is the new length.
5. mix - sources are mixed to target weights; rows are the documents taken,
   with their words taken.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm import decontam, mixing, overlap_join, pii, toxicity
from quarry.llm.common import bounded, written
from quarry.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str, at: float = 0.3) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return model.attach(docs).where(F.col("_tox_score") < at).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = written(overlap_join.text_components(docs, k=5, num=80, den=100), "duplicates")
    first = found.groupBy("component").agg(F.min(F.struct("doc_id", "h")).alias("r")).select("r.doc_id", "r.h")
    first = written(first, "first-rows")
    # rows go by id and text: an id may repeat with another text
    gone = found.join(first, ["doc_id", "h"], "left_anti").select(F.col("doc_id").alias("_d"), F.col("h").alias("_dh"))
    gone = written(gone.distinct(), "gone")
    again = written(found.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                    .select(F.col("doc_id").alias("_d"), F.col("h").alias("_dh")), "repeated-rows")
    hashed = docs.withColumn("_h", overlap_join.text_hash(F.col("text")))

    def among(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        return rows.join(bounded(keys, 40), (rows["doc_id"] == F.col("_d")) & (rows["_h"] == F.col("_dh")), how)
    kept = among(hashed, gone, "left_anti")
    if again.limit(1).count() == 0:
        return kept.select(*docs.columns)
    one = among(kept, again, "left_semi").dropDuplicates(["doc_id", "_h"])
    return among(kept, again, "left_anti").unionByName(one).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontam.scan(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    bad = written(found.where("contaminated").select(F.col("doc_id").alias("_d"), F.col("h").alias("_dh")).distinct(),
                  "contaminated")
    h = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(bounded(bad, 40), docs["doc_id"].eqNullSafe(F.col("_d")) & (h == F.col("_dh")), "left_anti")


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pii.redact(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_texts(mixing.mix(docs, texts=True))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("pii", redact_pii),
    ("mix", mix_sources),
]

#: boosted trees and vote reliabilities are not SQL; tests hold the stages
#: against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
