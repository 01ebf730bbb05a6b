"""The SVD in blocks of documents: any vocabulary, several blocks, restarts, all terms of the corpus."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import text
from test_svd_products import _matrix


@pytest.fixture(autouse=True)
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 30)
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def _dense(a):
    out = np.zeros((60, 90))
    for r in a.collect():
        out[r["doc_id"], r["term_idx"]] = r["tfidf"]
    return out


def _vectors(v, n):
    out = np.zeros((n, 3))
    for r in v.collect():
        out[r[0], r["concept"]] = r["weight"]
    return out


@pytest.mark.parametrize("entries, columns", [(2_000_000, 128), (40, 128), (300, 20)])
def test_a_large_vocabulary_joins_no_entries(spark, monkeypatch, entries, columns):
    """A term matrix above TERM_MATRIX used to make every round join the entries twice."""
    def none(*_a, **_k):
        raise AssertionError("the entries were joined")
    monkeypatch.setattr(text, "_apply", none)
    monkeypatch.setattr(text, "TERM_MATRIX", 0)
    monkeypatch.setattr(text, "ENTRIES", entries)
    monkeypatch.setattr(text, "COLUMNS", columns)
    a = _matrix(spark).localCheckpoint()
    want = np.linalg.svd(_dense(a), full_matrices=False)
    u, v, s = text.svd(a, 90, 3)
    assert np.allclose(s, want[1][:3], rtol=1e-9)
    uu, vv = _vectors(u, 60), _vectors(v, 90)
    assert np.allclose(abs(uu), abs(want[0][:, :3]), atol=1e-6) and np.allclose(abs(vv), abs(want[2][:3].T), atol=1e-6)
    assert np.allclose(uu * s, _dense(a) @ vv, atol=1e-5) and (vv[abs(vv).argmax(0), range(3)] > 0).all()


def test_a_product_is_that_of_joins(spark, monkeypatch):
    monkeypatch.setattr(text, "ENTRIES", 100)
    a = _matrix(spark).select("doc_id", "term_idx", F.col("tfidf").alias("a")).localCheckpoint()
    b = text._Blocks(a, 90, 3)
    assert b.laid.count() > 3
    b.first(3, 90, 5)
    rows = lambda df: df.groupBy("doc_id").pivot("concept", [0, 1, 2]).agg(F.first("weight"))
    q = rows(b.docs(np.eye(3))).select("doc_id", F.array("0", "1", "2").alias("q"))
    z = text._apply(a, "doc_id", "term_idx", q, 3).withColumnRenamed("y", "q")
    want = {r["doc_id"]: r["y"] for r in text._apply(a, "term_idx", "doc_id", z, 3).collect()}
    b.product(np.eye(3), 2)
    got = {r["doc_id"]: [r["0"], r["1"], r["2"]] for r in rows(b.docs(np.vstack([np.zeros((3, 3)), np.eye(3)]))).collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k], rtol=1e-10) for k in want)


def test_tfidf_by_both_joins(spark, monkeypatch):
    tf = spark.createDataFrame([(d, f"t{t}", t + 1) for d in range(6) for t in range(d, 9)], "doc_id long, term string, tf long")
    got = []
    for most in (100, 2):
        monkeypatch.setattr(text, "BROADCAST_TERMS", most)
        t = text.tfidf(tf, text.every_term(tf), 6)
        got.append((t.columns, sorted(map(tuple, t.collect()))))
    assert got[0] == got[1] and len(got[0][1]) == 39


def test_concept_terms_of_every_term(spark):
    """Not of the 20 commonest terms alone: against the dense matrix of the corpus."""
    import __spark_entry__ as entry
    from quarry.plans.queries import text as queries
    d = "/root/testdata/sf0.001"
    tf = queries._tf(spark, d).toPandas()
    docs, terms = (sorted(tf[c].unique()) for c in ("doc_id", "term"))
    m = spark.read.parquet(f"{d}/documents.parquet").count()
    a = np.zeros((len(docs), len(terms)))
    a[np.searchsorted(docs, tf["doc_id"]), np.searchsorted(terms, tf["term"])] = tf["tf"]
    a *= np.log((m + 1) / ((a > 0).sum(0) + 1))
    v = np.linalg.svd(a, full_matrices=False)[2][:4]
    v *= np.sign(v[range(4), abs(v).argmax(1)])[:, None]
    got = entry.queries()["concept_terms"](spark, d).collect()
    assert len(got) == 40
    for c in range(4):
        top = sorted((r for r in got if r["concept"] == c), key=lambda r: r["rank"])
        assert np.allclose([r["weight"] for r in top], np.sort(v[c])[::-1][:10], atol=2e-6)
        assert np.allclose([v[c][terms.index(r["term"])] for r in top], [r["weight"] for r in top], atol=2e-6)
