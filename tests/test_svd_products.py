"""Products inside tasks are those of the joins."""

import numpy as np
from pyspark.sql import functions as F

from quarry.operators import text


def _matrix(spark, docs=60, terms=90):
    h = lambda seed: F.pmod(F.xxhash64("doc_id", "term_idx", F.lit(seed)), F.lit(1000))
    x = spark.range(docs).withColumnRenamed("id", "doc_id").crossJoin(spark.range(terms).select(F.col("id").cast("int").alias("term_idx")))
    return x.where((h(1) < 300) | (F.col("term_idx") == F.col("doc_id") + 1)).withColumn("tfidf", h(2) / 100.0)


def test_svd_by_both_ways(spark, monkeypatch):
    a = _matrix(spark).localCheckpoint()
    dense = np.zeros((60, 90))
    for r in a.collect():
        dense[r["doc_id"], r["term_idx"]] = r["tfidf"]
    want = np.linalg.svd(dense, compute_uv=False)[:3]
    got = {}
    for most in (0, 64 << 20):
        monkeypatch.setattr(text, "TERM_MATRIX", most)
        u, v, s = text.svd(a, 90, 3)
        assert np.allclose(s, want, rtol=1e-6)
        got[most] = {(r["doc_id"], r["concept"]): r["weight"] for r in u.collect()}
        assert len(got[most]) == 180
    assert all(abs(got[0][k] - got[64 << 20][k]) < 1e-5 for k in got[0])


def test_rounds_shuffle_no_entries(spark, monkeypatch):
    """A round by joins shuffles the entries of the matrix twice."""
    def none(*_a, **_k):
        raise AssertionError("the entries were joined")
    monkeypatch.setattr(text, "_apply", none)
    assert len(text.svd(_matrix(spark), 90, 3)[2]) == 3


def test_documents_that_cross_chunks(spark, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(text, "ENTRIES", 4)
    doc = [None, None, 1, 1, 1, 1, 1, 1, 2, 3, 3]
    t = pa.table({"doc_id": pa.array(doc, pa.int64()), "n": range(11)})
    got = [(c.column("doc_id").to_pylist(), list(at)) for c, at in text._doc_chunks(t.to_batches(max_chunksize=3))]
    assert sum((d for d, _ in got), []) == doc
    assert sum(len(at) for _, at in got) == 4
