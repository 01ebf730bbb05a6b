"""Text queries: tokens, TF-IDF, cosine, SVD concepts."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import lemmas as lemma_ops
from quarry.operators import text
from quarry.plans import roles
from quarry.plans.registry import query
from quarry.session import last_use, stand_in_source
from quarry.sources.tables import table


VOCAB_SIZE = 20


def _tf(spark, d):
    """(doc_id, term, tf), written once per application to the shared folder:
    every text query reads it, and the corpus is tokenised only once."""
    path = stand_in_source(spark, "term-counts", d, lambda p: text.term_counts(
        text.remove_stop_words(text.tokens(roles.corpus(spark, d)))).write.parquet(p))
    return spark.read.parquet(path)


def _tfidf(spark, d):
    docs = roles.corpus(spark, d)
    tf = _tf(spark, d)
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    return text.tfidf(tf, text.vocabulary(tf, VOCAB_SIZE), n_docs)


@query("tokens")
def tokens(spark, d):
    return _tf(spark, d)


@query("lemmas")
def lemmas(spark, d):
    """Counts per document and lemma, over the words of every document."""
    langs = table(spark, d, "documents", "doc_id", "lang")
    return lemma_ops.lemma_counts(_tf(spark, d).join(langs, "doc_id"), lemma_ops.form_table(spark),
                                  lemma_ops.ending_table(spark))


@query("tfidf")
def tfidf(spark, d):
    t = _tfidf(spark, d)
    return t.select("doc_id", "term", "tf", F.round("idf", 6).alias("idf"), F.round("tfidf", 6).alias("tfidf"))


@query("doc_cosine")
def doc_cosine(spark, d):
    """Ten documents most similar (TF-IDF cosine) to the first document."""
    unit = text.normalize_rows(_tfidf(spark, d))
    q = roles.corpus(spark, d).select(F.min("doc_id")).scalar()
    c = text.cosine_to(unit, q)
    # copies of a document tie at cosine 1 up to float noise: rank on a
    # rounded key, then doc id, so ties break the same way everywhere
    top = c.orderBy(F.round("cosine", 9).desc(), F.col("doc_id").asc()).limit(10)
    return top.select("doc_id", F.round("cosine", 6).alias("cosine"))


def _svd(spark, d, k=4):
    t = _tfidf(spark, d).checkpoint()
    return text.svd(t, VOCAB_SIZE, k), t


def _top_terms(spark, d, k=4, **settings):
    """The concepts' top terms when the whole vocabulary takes part, and the
    concepts' singular values."""
    docs = roles.corpus(spark, d)
    tf = _tf(spark, d)
    vocab = last_use(text.every_term(tf), lambda x: x.checkpoint())
    t = text.tfidf(tf, vocab, docs.select(F.count(F.lit(1))).scalar())
    u, v, s = text.svd(t, vocab.count(), k, **settings)
    # terms are numbered in their order: ties break as by the term
    top = text.top_per_concept(v, "term_idx", 10)
    return vocab.join(F.broadcast(top), "term_idx"), s   # ten rows a concept


@query("concept_terms")
def concept_terms(spark, d):
    top, _ = _top_terms(spark, d)
    return top.select("concept", "rank", "term", F.round("weight", 6).alias("weight"))


@query("concept_docs")
def concept_docs(spark, d):
    (u, v, s), t = _svd(spark, d)
    top = text.top_per_concept(u, "doc_id", 10)
    title = F.substring(F.trim(F.regexp_extract("text", r"^\s*([^\r\n]*)", 1)), 1, 80)
    titles = roles.corpus(spark, d).select("doc_id", title.alias("title"))
    return top.join(titles, "doc_id").select("concept", "rank", "doc_id", "title", F.round("weight", 6).alias("weight"))


@query("concept_terms_all")
def concept_terms_all(spark, d):
    """The concepts' top terms, with the singular value of each concept."""
    top, s = _top_terms(spark, d, tol=1e-6)
    value = F.get(F.lit(s or [0.0]), F.col("concept"))
    return top.select("concept", "rank", "term", F.round("weight", 4).alias("weight"), F.round(value, 2).alias("strength"))
