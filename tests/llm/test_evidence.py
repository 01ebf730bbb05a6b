"""Cases that a round before had got wrong: long words, long chains of hosts,
evidence that all agrees, rare labels."""
import numpy as np

from quarry.llm import bytehash, linkgraph, pii, toxicity
from quarry.llm.queries import QUERIES

from tests.llm.conftest import rows_of


def test_long_words_do_not_collide(spark, tables):
    """Structured words on which polynomial hashes modulo 2**64 are equal."""
    a, b = "a", "b"
    words = []
    for _ in range(13):
        a, b = a + b, b + a
        if len(a) >= 512:
            words += [a, b]
    assert len(set(words)) == len({bytehash.word_hashes(w)[0] for w in words})
    tables.put("documents", [(i, "one two three four " + w, "en", "s", 1) for i, w in enumerate(words)])
    got = {r["doc_id"]: r["component_id"] for r in rows_of(QUERIES["op8_jaccard_join"](spark, tables.dir))}
    assert got == {i: i for i in range(len(words))}


def test_distrust_reaches_far_hosts(spark, tables):
    """A chain of 40 hosts that ends at a blocked one; another that ends nowhere."""
    name = lambda i: f"h{i}.net" if i < 40 else "a.com"
    pages = [(i, f"http://{name(i)}/x", f'<a href="http://{name(i + 1)}/de/1">x</a>') for i in range(40)]
    pages += [(100 + i, f"http://g{i}.net/x", f'<a href="http://g{i + 1}.net/">x</a>') for i in range(40)]
    pages += [(200, "http://a.com/de/1", ""), (201, "http://t.org/", '<a href="http://g0.net/">x</a>')]
    tables.put("pages", pages)
    got = {r["page_id"]: r["verdict"] for r in rows_of(QUERIES["op6_url_filter"](spark, tables.dir))}
    assert [got[i] for i in range(40)] == ["block"] * 40
    assert [got[100 + i] for i in range(40)] == ["allow"] * 40


def test_walk_settles(spark):
    rng = np.random.default_rng(1)
    n = 25
    w = (rng.random((n, n)) < 0.15) * rng.integers(1, 4, (n, n))
    np.fill_diagonal(w, 0)
    w[np.arange(n), (np.arange(n) + 1) % n] += 1
    edges = spark.createDataFrame([(f"h{i}", f"h{j}", float(w[i, j])) for i in range(n) for j in range(n) if w[i, j]],
                                  "src string, dst string, weight double")
    seeds = spark.createDataFrame([("h0", 0.7), ("h5", 0.3)], "host string, mass double")
    s = np.zeros(n)
    s[0], s[5] = 0.7, 0.3
    p = w / w.sum(axis=1, keepdims=True)
    want = np.linalg.solve(np.eye(n) - 0.85 * p.T, 0.15 * s)
    for size, tol in (1000, 1e-5), (8, 2e-3):  # one block; blocks that hand mass to each other
        got = {r["host"]: r["score"] for r in linkgraph.personalised_rank(edges, seeds, tol=tol, size=size).collect()}
        assert np.abs([got[f"h{i}"] - want[i] for i in range(n)]).sum() < tol


def test_hub_and_split_site(spark, monkeypatch):
    """A hub's edges are dealt over shares and a site over blocks; isolated and empty seeds."""
    monkeypatch.setattr(linkgraph, "HOT", 3)
    n = 20
    e = [("hub.s.net", f"h{i}.s.net", 1.0) for i in range(n)] + [(f"h{i}.s.net", "hub.s.net", 2.0) for i in range(0, n, 2)]
    edges = spark.createDataFrame(e, "src string, dst string, weight double")
    seeds = spark.createDataFrame([("hub.s.net", 0.5), ("alone.org", 0.5)], "host string, mass double")
    got = {r["host"]: r["score"] for r in linkgraph.personalised_rank(edges, seeds, tol=1e-3, size=5).collect()}
    hub = 0.075 / (1 - 0.85 ** 2 / 2)
    assert abs(got["hub.s.net"] - hub) < 1e-3 and abs(got["alone.org"] - 0.075) < 1e-12
    assert all(abs(got[f"h{i}.s.net"] - 0.85 * hub / n) < 1e-3 for i in range(n))
    assert linkgraph.personalised_rank(edges, seeds.limit(0)).collect() == []
    assert {r["host"] for r in linkgraph.personalised_rank(edges.limit(0), seeds).collect()} == {"hub.s.net", "alone.org"}


def test_keys_alone_are_found(spark):
    """Every candidate's evidence says key: none is given up."""
    docs = spark.createDataFrame([(i, f"text {i} pwd = 'a{i:02d}9f8e7d6c5b4a39{i:02d}e1' end") for i in range(35)],
                                 "doc_id long, text string")
    got = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in pii.report(docs).collect()}
    assert got == {i: ["secret"] for i in range(35)}
    words = spark.createDataFrame([(i, f"version of chapter{i}names") for i in range(9)], "doc_id long, text string")
    assert all(not r["spans"] for r in pii.report(words).collect())


def test_rare_labels_are_cross_fitted(spark):
    """A dozen toxic rows: they are found, and a label's only row does not fail."""
    docs = [(i, f"you stupid moron number {i} get lost") for i in range(12)]
    docs += [(100 + i, f"the quiet garden by the river had {i} trees and a bench") for i in range(60)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    for few in (12, 1):
        labels = spark.createDataFrame([(i, 1) for i in range(few)] + [(100 + i, 0) for i in range(60)], "doc_id long, toxic int")
        got = {r["doc_id"]: r["score"] for r in toxicity.classify(docs, labels, mod=10_000, held=9_999).collect()}
        assert len(got) == 72 and all(0 <= s <= 1 for s in got.values())
        if few > 1:
            assert np.mean([got[i] for i in range(12)]) > 0.5 > np.mean([got[100 + i] for i in range(60)])
