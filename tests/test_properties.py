"""Property tests (hypothesis) on small generated inputs."""
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.operators.graph import merge_min_maps

maps = st.dictionaries(st.sampled_from(list("abcde")), st.integers(0, 9), max_size=5)


def _merge(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a map<string,int>, b map<string,int>")
    return df.select(merge_min_maps(F.col("a"), F.col("b")).alias("m")).first()["m"]


@settings(max_examples=15, deadline=None)
@given(a=maps, b=maps)
def test_map_min_merge_commutative_idempotent(spark, a, b):
    ab = _merge(spark, a, b)
    assert ab == _merge(spark, b, a)
    assert _merge(spark, a, a) == a
    assert ab == {k: min(a.get(k, 10**9), b.get(k, 10**9)) for k in set(a) | set(b)}


@settings(max_examples=10, deadline=None)
@given(vals=st.lists(st.floats(-100, 100, allow_nan=False), min_size=1, max_size=60))
def test_select_kth_matches_sort(spark, vals):
    from quarry.operators import risk
    df = spark.createDataFrame([(float(v),) for v in vals], "ret double")
    r = risk.var_cvar(df).first()
    k = max(len(vals) // 20, 1)
    s = sorted(vals)
    assert r.var == s[k - 1]
    assert abs(r.cvar - sum(s[:k]) / k) < 1e-9


@settings(max_examples=8, deadline=None)
@given(quotes=st.lists(st.tuples(st.integers(0, 40), st.floats(1, 100, allow_nan=False)),
                       min_size=1, max_size=15))
def test_fill_never_looks_ahead(spark, quotes):
    import datetime as dt
    from quarry.operators import risk
    base = dt.date(2021, 3, 1)
    q = {}
    for day, p in quotes:
        q[base + dt.timedelta(days=day)] = p          # one quote per date
    df = spark.createDataFrame([("x", d, float(p)) for d, p in q.items()],
                               "instrument string, date date, price double")
    start, end = base, base + dt.timedelta(days=41)
    got = {r.date: r.price for r in risk.fill_calendar(df, start.isoformat(), end.isoformat()).collect()}
    first = q[min(q)]
    for d, p in got.items():
        past = [x for x in q if x <= d]
        want = q[max(past)] if past else first
        assert p == want
        assert d.weekday() < 5 and start <= d < end


def test_component_label_constant_over_edges(spark):
    import __spark_entry__ as entry
    from quarry.plans import roles
    d = "/root/testdata/sf0.01"
    comp = {r.id: r.component for r in entry.queries()["components"](spark, d).collect()}
    for e in roles.handoff_edges(spark, d).collect():
        assert comp[e.src] == comp[e.dst]
    assert all(c <= i for i, c in comp.items())


def test_svd_factors_orthonormal(spark):
    import numpy as np
    from quarry.plans import catalog
    (u, v, s), _ = catalog._svd(spark, "/root/testdata/sf0.001")
    vv = np.zeros((20, 4))
    for r in v.collect():
        vv[r.term_idx, r.concept] = r.weight
    assert np.allclose(vv.T @ vv, np.eye(4), atol=1e-8)
    assert all(a >= b for a, b in zip(s, s[1:]))


@settings(max_examples=8, deadline=None)
@given(rows=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 500), st.integers(0, 9)),
                     min_size=1, max_size=40, unique_by=lambda r: (r[0], r[1])))
def test_bucketed_order_ops_equal_plain_windows(spark, rows):
    """next_in_order / running_sum split by (key, bucket) give the plain
    per-key window answers, including across bucket boundaries."""
    from pyspark.sql import Window
    from quarry.operators import ordered
    df = spark.createDataFrame(rows, "k int, t int, v int")
    bucket = F.floor(F.col("t") / 37)
    got = ordered.next_in_order(df, "k", ["t"], ["v"], bucket)
    got = ordered.running_sum(got, "k", ["t"], "v", bucket, "run")
    w = Window.partitionBy("k").orderBy("t")
    want = df.select("k", "t", F.lead("v").over(w).alias("next_v"),
                     F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("run"))
    g = sorted((r.k, r.t, r.next_v, r.run) for r in got.collect())
    e = sorted((r.k, r.t, r.next_v, r.run) for r in want.collect())
    assert g == e


@settings(max_examples=8, deadline=None)
@given(recs=st.lists(st.tuples(st.integers(0, 2), st.sampled_from("xy"),
                               st.one_of(st.none(), st.sampled_from("abc"))), min_size=2, max_size=25))
def test_pair_free_linkage_counts_equal_brute_force(spark, recs):
    """Sums of binomials of value counts == statistics over explicit pairs."""
    from itertools import combinations
    from quarry.operators import linkage
    df = spark.createDataFrame(recs, "block int, label string, f string")
    got = {r.matched: (r.pairs, r.nonnull, r.agree)
           for r in linkage.pair_field_counts(df, "block", "label", ["f"]).collect()}
    want = {True: [0, 0, 0], False: [0, 0, 0]}
    for (b1, l1, f1), (b2, l2, f2) in combinations(recs, 2):
        if b1 != b2:
            continue
        w = want[l1 == l2]
        w[0] += 1
        if f1 is not None and f2 is not None:
            w[1] += 1
            w[2] += f1 == f2
    assert {k: tuple(float(x) for x in v) for k, v in want.items()} == got


@settings(max_examples=8, deadline=None)
@given(items=st.lists(st.tuples(st.integers(0, 3), st.sampled_from("abcdefg")), min_size=1, max_size=40),
       chunk=st.integers(1, 4))
def test_salted_pairs_equal_brute_force(spark, items, chunk):
    from itertools import combinations
    from quarry.operators import cooccur
    df = spark.createDataFrame(items, "basket long, topic string")
    dist = cooccur.distinct_baskets(df, "basket", "topic")
    got = {(r.topic_a, r.topic_b): r.cnt for r in cooccur.pair_counts(dist, chunk).collect()}
    baskets = {}
    for b, t in items:
        baskets.setdefault(b, set()).add(t)
    want = {}
    for ts in baskets.values():
        for a, b in combinations(sorted(ts), 2):
            want[(a, b)] = want.get((a, b), 0) + 1
    assert got == want


@settings(max_examples=6, deadline=None)
@given(edges=st.lists(st.tuples(st.integers(0, 11), st.integers(0, 11)), max_size=30))
def test_scc_equals_brute_force(spark, edges):
    from quarry.operators import graph
    n = 12
    reach = [[i == j for j in range(n)] for i in range(n)]
    for a, b in edges:
        reach[a][b] = True
    for k in range(n):                      # Floyd-Warshall transitive closure
        for i in range(n):
            if reach[i][k]:
                for j in range(n):
                    reach[i][j] = reach[i][j] or reach[k][j]
    want = {i: min(j for j in range(n) if reach[i][j] and reach[j][i]) for i in range(n)}
    v = spark.createDataFrame([(i,) for i in range(n)], "id long")
    e = spark.createDataFrame(edges or [(0, 0)], "src long, dst long")
    got = {r.id: r.component for r in graph.strongly_connected_components(v, e).collect()}
    assert got == want
