"""The registered queries of this package: each applies one operator, with its
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import alignment, collocations, decontam, linkgraph, lpf, mixing, overlap_join, ownership, pii, quality, topk, toxicity, warc
from quarry.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents", "doc_id", "text"),
                            table(spark, sf_dir, "labels", "doc_id", "quality"))


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lpf.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"), 400, keep="none")
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents", "doc_id", "text", "source")).drop("source")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages", "page_id", "url", "html")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkgraph.judge(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.scan(table(spark, sf_dir, "documents", "doc_id", "text"),
                          table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap_join.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), k=4, num=85, den=100)


def op8_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap_join.link_counts(table(spark, sf_dir, "documents", "doc_id", "text"), k=4, num=85, den=100)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents", "doc_id", "text"),
                             table(spark, sf_dir, "labels", "doc_id", "toxic"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.report(table(spark, sf_dir, "documents", "doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda x: x["k"] <= len(pii.BASE))
    return found.select("doc_id", *[count(k) for k in pii.BASE],
                        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
                        _listed(F.col("spans")).alias("spans"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents", "text", "lang"), floor=100, top=2000)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents", "doc_id", "text"))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also ``n_live`` and ``n_shared``: base spans whose value one owner holds, or several."""
    found = ownership.scan(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    base = F.filter("spans", lambda x: x["k"] < len(ownership.BASE))

    def count(test) -> Column:
        return F.size(F.filter(base, test)).cast("long")
    kept = F.filter("spans", lambda x: (x["k"] < len(ownership.BASE)) | x["live"])

    def of_kind(kind: str) -> Column:
        return count(lambda x: x["kind"] == kind).alias(f"n_{kind}")
    return found.select("doc_id", *map(of_kind, ownership.BASE),
                        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"), _listed(kept).alias("spans"),
                        count(lambda x: x["live"]).alias("n_live"), count(lambda x: ~x["live"]).alias("n_shared"))


QUERIES: dict[str, Query] = {
    "op1_topk": op1_topk,
    "op2_quality": op2_quality,
    "op3_repeats": op3_repeats,
    "op4_mix": op4_mix,
    "op5_warc": op5_warc,
    "op6_url_filter": op6_url_filter,
    "op7_decontaminate": op7_decontaminate,
    "op8_jaccard_join": op8_jaccard_join,
    "op8_jaccard_links": op8_jaccard_links,
    "op9_toxicity": op9_toxicity,
    "op10_pii": op10_pii,
    "op11_collocations": op11_collocations,
    "op12_alignment": op12_alignment,
    "op13_secrets": op13_secrets,
}
