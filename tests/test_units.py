"""Closed-form checks on hand-made rows."""
import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions.expr import chi_square, point_in_polygon, polygon_area
from quarry.operators import cooccur, graph, linkage, recommend, risk, trips


def test_chi_square_closed_form(spark):
    yy, yb, ya, t = 10, 30, 40, 200
    nb, na = t - yb, t - ya
    yn, ny = ya - yy, yb - yy
    nn = t - ny - yn - yy
    want = t * (abs(yy * nn - yn * ny) - t / 2) ** 2 / (ya * na * yb * nb)
    got = spark.range(1).select(chi_square(F.lit(yy), F.lit(yb), F.lit(ya), F.lit(t)).alias("c")).first()["c"]
    assert math.isclose(got, want, rel_tol=1e-12)
    # zero margin -> NULL, not an ANSI error
    assert spark.range(1).select(chi_square(F.lit(1), F.lit(5), F.lit(5), F.lit(5)).alias("c")).first()["c"] is None


def test_chi_square_symmetric(spark):
    a = spark.range(1).select(chi_square(F.lit(3), F.lit(9), F.lit(14), F.lit(60)).alias("c")).first()["c"]
    b = spark.range(1).select(chi_square(F.lit(3), F.lit(14), F.lit(9), F.lit(60)).alias("c")).first()["c"]
    assert math.isclose(a, b)


def test_pairs_dedupe_and_salt(spark):
    items = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (1, "c"), (2, "b"), (2, "c")],
                                  "basket long, topic string")
    dist = cooccur.distinct_baskets(items, "basket", "topic")
    for chunk in (1, 2, 1024):   # chunk 1 splits basket 1 into three salt buckets
        got = {(r.topic_a, r.topic_b): r.cnt for r in cooccur.pair_counts(dist, chunk).collect()}
        assert got == {("a", "b"): 1, ("a", "c"): 1, ("b", "c"): 2}


def test_point_in_polygon_edges(spark):
    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"))
                     for x, y in [(0, 0), (10, 0), (10, 10), (0, 10)]])
    pts = [(5.0, 5.0, True), (0.0, 5.0, True), (10.0, 5.0, False), (5.0, 0.0, True), (5.0, 10.0, False),
           (11.0, 5.0, False)]
    df = spark.createDataFrame(pts, "x double, y double, want boolean")
    rows = df.select("want", point_in_polygon(F.col("x"), F.col("y"), ring).alias("got")).collect()
    assert all(r.want == r.got for r in rows)
    assert spark.range(1).select(polygon_area(ring).alias("a")).first()["a"] == 100.0


def test_zone_first_match_and_default(spark):
    zones = spark.createDataFrame(
        [(2, "big", [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]),
         (1, "small", [(0.0, 0.0), (5.0, 0.0), (5.0, 5.0), (0.0, 5.0)]),
         (1, "tiny", [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)])],
        "zone_code int, zone string, ring array<struct<x:double,y:double>>")
    t = spark.createDataFrame([(1, (1.0, 1.0)), (2, (7.0, 7.0)), (3, (20.0, 20.0)), (4, (3.0, 3.0))],
                              "trip_id long, dropoff_loc struct<x:double,y:double>")
    got = {r.trip_id: r.zone for r in trips.assign_zone(t, zones).collect()}
    # code 1 wins over code 2; within code 1 the larger area wins
    assert got == {1: "small", 2: "big", 3: "NA", 4: "small"}


def test_match_weights_and_missing(spark):
    # block 0: labels x, x, y; field f: 1, 1, NULL
    rec = spark.createDataFrame([(0, "x", "1"), (0, "x", "1"), (0, "y", None)],
                                "block int, label string, f string")
    c = {r.matched: r for r in linkage.pair_field_counts(rec, "block", "label", ["f"]).collect()}
    assert (c[True].pairs, c[True].nonnull, c[True].agree) == (1, 1, 1)
    assert (c[False].pairs, c[False].nonnull, c[False].agree) == (2, 0, 0)
    s = {r.matched: r for r in linkage.missing_stats(linkage.pair_field_counts(
        rec, "block", "label", ["f"])).collect()}
    assert s[False].missing == 2 and s[False].mean is None


def test_auc_ties_score_zero(spark):
    pos = spark.createDataFrame([(1, 0.5), (1, 0.9)], "user long, score double")
    neg = spark.createDataFrame([(1, 0.5), (1, 0.1)], "user long, score double")
    auc = recommend.auc_per_user(pos, neg).first()["auc"]
    # pairs: (.5,.5) tie=0, (.5,.1)=1, (.9,.5)=1, (.9,.1)=1 -> 3/4
    assert auc == 0.75


def test_negative_sampling_excludes_positives(spark):
    pos = spark.createDataFrame([(1, i) for i in range(5)] + [(2, 7)], "user long, item long")
    items = spark.createDataFrame([(i,) for i in range(10)], "item long")
    neg = recommend.sample_negatives(pos, items, seed=3).collect()
    by = {}
    for r in neg:
        by.setdefault(r.user, []).append(r.item)
    assert len(by[1]) == 5 and all(i >= 5 for i in by[1])
    assert len(by[2]) == 1 and by[2][0] != 7


def test_fill_weekend_quote_and_padding(spark):
    q = spark.createDataFrame(
        [("a", dt.date(2020, 1, 7), 2.0),   # Tuesday: Mon 6 is padded with it
         ("a", dt.date(2020, 1, 11), 5.0),  # Saturday quote, used from Monday 13
         ("a", dt.date(2020, 1, 20), 9.0)],  # end date itself: excluded from [start, end)
        "instrument string, date date, price double")
    f = {r.date: r.price for r in risk.fill_calendar(q, "2020-01-06", "2020-01-20").collect()}
    assert f[dt.date(2020, 1, 6)] == 2.0 and f[dt.date(2020, 1, 10)] == 2.0
    assert f[dt.date(2020, 1, 13)] == 5.0 and dt.date(2020, 1, 20) not in f
    assert all(d.weekday() < 5 for d in f)


def test_horizon_return_zero_first(spark):
    rows = [("a", dt.date(2020, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(12)]
    f = spark.createDataFrame(rows, "instrument string, date date, price double")
    r = sorted(risk.horizon_returns(f, 10).collect(), key=lambda x: x.date)
    assert len(r) == 3 and r[0].ret == 0.0 and math.isclose(r[1].ret, (10 - 1) / 1)


def test_var_cvar_small_and_exact(spark):
    vals = [5.0, -1.0, 3.0, -7.0, 2.0, 2.0, -7.0]
    df = spark.createDataFrame([(v,) for v in vals], "ret double")
    r = risk.var_cvar(df).first()   # n < 20 -> k = 1
    assert r.var == -7.0 and r.cvar == -7.0
    big = np.random.default_rng(0).normal(size=1000)
    df = spark.createDataFrame([(float(v),) for v in big], "ret double")
    r = risk.var_cvar(df).first()
    s = np.sort(big)
    assert r.var == s[49] and math.isclose(r.cvar, s[:50].mean(), rel_tol=1e-12)


def test_triangles_and_clustering(spark):
    v = spark.createDataFrame([(i,) for i in range(5)], "id long")
    e = spark.createDataFrame([(0, 1), (1, 2), (2, 0), (2, 3), (3, 0), (4, 4)], "src long, dst long")
    t = {r.id: r.triangles for r in graph.triangle_count(v, e).collect()}
    assert t == {0: 2, 1: 1, 2: 2, 3: 1, 4: 0}
    c = {r.id: r.coef for r in graph.clustering_coefficient(v, e).collect()}
    assert c[1] == 1.0 and c[4] is None


def test_scc_and_components(spark):
    v = spark.createDataFrame([(i,) for i in range(6)], "id long")
    e = spark.createDataFrame([(1, 2), (2, 1), (2, 3), (3, 4), (4, 3), (5, 5)], "src long, dst long")
    s = {r.id: r.component for r in graph.strongly_connected_components(v, e).collect()}
    assert s == {0: 0, 1: 1, 2: 1, 3: 3, 4: 3, 5: 5}
    c = {r.id: r.component for r in graph.connected_components(v, e).collect()}
    assert c == {0: 0, 1: 1, 2: 1, 3: 1, 4: 1, 5: 5}


def test_pagerank_mass_without_dangling(spark):
    v = spark.createDataFrame([(i,) for i in range(3)], "id long")
    e = spark.createDataFrame([(0, 1), (1, 2), (2, 0)], "src long, dst long")
    r = graph.pagerank(v, e, 0.15, 5).collect()
    assert math.isclose(sum(x.rank for x in r), 1.0) and all(math.isclose(x.rank, 1 / 3) for x in r)


def test_zone_grid_join_equals_broadcast(spark):
    from quarry.plans import roles
    ev = spark.createDataFrame([(i, (float(i % 101), float((i * 37) % 101))) for i in range(2000)],
                               "trip_id long, dropoff_loc struct<x:double,y:double>")
    z = spark.createDataFrame([(c, n, [(float(a), float(b)) for a, b in ring]) for c, n, ring in roles.ZONES],
                              "zone_code int, zone string, ring array<struct<x:double,y:double>>")
    a = {r.trip_id: r.zone for r in trips.assign_zone(ev, z).collect()}
    b = {r.trip_id: r.zone for r in trips.assign_zone(ev, z, cell=7.0).collect()}
    assert a == b and len(set(a.values())) > 2


def test_negative_sampling_chunked_draws_identical(spark, monkeypatch):
    pos = spark.createDataFrame([(u, i) for u in range(4) for i in range(u * 3, u * 3 + 7)],
                                "user long, item long")
    items = spark.createDataFrame([(i,) for i in range(40)], "item long")
    one = sorted(tuple(r) for r in recommend.sample_negatives(pos, items, seed=5).collect())
    monkeypatch.setattr(recommend, "DRAW_CHUNK", 3)
    many = sorted(tuple(r) for r in recommend.sample_negatives(pos, items, seed=5).collect())
    assert one == many and len(one) == 28


def test_consecutive_pairs_hot_key_across_partitions(spark):
    from pyspark.sql import Window
    from quarry.operators import basic
    rows = [("hot", i, i * 10) for i in range(300)] + [("a", i, i) for i in range(5)] + [("z", 0, 0)]
    df = spark.createDataFrame(rows, "k string, t long, v long")
    got = basic.consecutive_pairs(df, "k", ["t"], "t", ["v"],
                                  "k string, t long, next_t long, v long, next_v long", partitions=16)
    w = Window.partitionBy("k").orderBy("t")
    want = (df.select("k", "t", F.lead("t").over(w).alias("next_t"), "v", F.lead("v").over(w).alias("next_v"))
            .where(F.col("next_t").isNotNull()))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
    assert got.count() == 299 + 4


def test_negative_sampling_dense_positives_no_round_cap(spark):
    # user 1 holds 95 of 100 items: only 5 distinct non-positives exist, so it
    # needs many draws; user 2 holds every item and gets none
    pos = spark.createDataFrame([(1, i) for i in range(95)] + [(2, i) for i in range(100)],
                                "user long, item long")
    items = spark.createDataFrame([(i,) for i in range(100)], "item long")
    neg = recommend.sample_negatives(pos, items, seed=1).collect()
    got = [r.item for r in neg if r.user == 1]
    assert all(i >= 95 for i in got) and len(got) >= 1
    assert not [r for r in neg if r.user == 2]
    # exactness: the negatives are the first non-positive draws in draw order
    import hashlib
    draws = [int(hashlib.md5(f"1|{j}|1".encode()).hexdigest()[:8], 16) % 100 for j in range(100)]
    want = [d for d in draws if d >= 95][:95]
    assert sorted(got) == sorted(want)


def test_alias_listed_twice_counts_plays_once(spark):
    from quarry.operators import recommend
    plays = spark.createDataFrame([(1, 10, 5)], "user long, item long, count long")
    alias = spark.createDataFrame([(10, 7), (10, 8)], "bad long, good long")
    assert [tuple(r) for r in recommend.resolve_alias(plays, alias).collect()] == [(1, 8, 5)]
    lines = spark.createDataFrame([("10\t8",), ("10\t7",), ("3\t",), ("",)], "value string").coalesce(1)
    assert [tuple(r) for r in recommend.parse_alias(lines).collect()] == [(10, 7)]


def test_equal_articles_stay_apart(spark, tmp_path):
    import json
    from quarry.sources import formats
    path = tmp_path / "a.json"
    path.write_text(json.dumps([{"title": "t", "text": "x"}, {"title": "t", "text": "x"}, {"title": "u", "text": "y"}]))
    ids = [r.doc_id for r in formats.articles(spark, str(path)).collect()]
    assert len(set(ids)) == 3
    assert sorted(ids) == sorted(r.doc_id for r in formats.articles(spark, str(path)).collect())


def test_handoff_graph_has_edges_and_grows(spark):
    from quarry.plans import roles
    n = [roles.handoff_edges(spark, f"/root/testdata/sf{sf}").count() for sf in ("0.001", "0.01", "0.1")]
    assert 0 < n[0] < n[1] < n[2]


def test_cover_rows_keep_every_embedding(spark):
    from quarry.plans import roles
    d = "/root/testdata/sf0.001"
    rows = roles.cover_rows(spark, d)
    assert rows.count() == spark.read.parquet(f"{d}/embeddings.parquet").count()
    r = rows.first()
    assert sum(r[c] for c in roles.WILD) == 1 and sum(r[c] for c in roles.SOIL) == 1


def test_sparse_distance_equals_dense(spark):
    import numpy as np
    from pyspark.ml.linalg import Vectors
    from quarry.operators import anomaly
    rows = [(i, Vectors.sparse(6, [i % 6], [1.0 + i])) for i in range(20)] + [(99, Vectors.dense([0, 1, 0, 2, 0, 0.5]))]
    df = spark.createDataFrame(rows, ["id", "features"])
    assert anomaly.used_entries(df) == [0, 1, 2, 3, 4, 5]
    x = anomaly.slicer([0, 1, 2, 3, 4, 5]).transform(df)
    model = anomaly.fit_kmeans(x, 3, 1)
    c = model.clusterCenters()
    for r in anomaly.score(model, x).collect():
        assert abs(r.distance - np.linalg.norm(r.features.toArray() - c[r.cluster])) < 1e-9


def test_grid_scores_every_fold(spark):
    """The grid's AUC is the mean over all folds, not that of the first."""
    from quarry.operators import recommend
    rows = [(u, i, 1 + (u * 7 + i * 5) % 11, (u + 3 * i) % 4) for u in range(6) for i in range(20) if (u * i) % 3 != 1]
    r = spark.createDataFrame(rows, "user long, item long, count long, fold int")
    neg = recommend.sample_negatives(r, r.select("item"), seed=42, group=("fold", "user")).checkpoint()
    each = []
    for f in range(4):
        a = recommend.area_under_curve(r.where(f"fold <> {f}"), r.where(f"fold = {f}"), r.select("item"),
                                       recommend.popularity_scorer, negatives=neg.where(f"fold = {f}").drop("fold"))
        each.append(a.agg({"auc": "avg"}).first()[0])
    assert len(set(each)) > 1
    seen = []

    def fit(train, setting):
        seen.append(setting)
        return lambda _, pairs: recommend.popularity_scorer(train, pairs)
    got = recommend.grid_auc(r, ["a", "b"], fit, folds=4)
    assert sorted(seen) == ["a"] * 4 + ["b"] * 4
    assert got == [pytest.approx(sum(each) / 4)] * 2


def test_centre_index_stays_out_of_the_plan(spark):
    """The plan of a scored frame does not grow with clusters or entries."""
    import numpy as np
    from pyspark.ml.linalg import Vectors
    from quarry.operators import anomaly
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, Vectors.dense(rng.normal(size=300))) for i in range(80)], ["id", "features"])
    sizes = []
    for width, k in ((20, 2), (300, 40)):
        x = anomaly.slicer(list(range(width))).transform(df)
        model = anomaly.fit_kmeans(x, k, 1, 3)
        got = anomaly.score(model, x)
        sizes.append(len(got._jdf.queryExecution().optimizedPlan().toString()))
        c = model.clusterCenters()
        for r in got.collect():
            assert abs(r.distance - np.linalg.norm(r.features.toArray()[:width] - c[r.cluster])) < 1e-5
    assert sizes[1] < 1.1 * sizes[0]


def _svd_rows(spark, a):
    rows = [(i, j, float(a[i, j])) for i in range(a.shape[0]) for j in range(a.shape[1]) if a[i, j]]
    return spark.createDataFrame(rows, "doc_id long, term_idx int, tfidf double").repartition(5)


def test_svd_equals_the_gram_way(spark):
    """20 terms: singular values and vectors of the dense decomposition."""
    import numpy as np
    from quarry.operators import text
    rng = np.random.default_rng(2)
    a = rng.normal(size=(60, 20)) * (rng.random((60, 20)) < 0.4)
    u, v, s = text.svd(_svd_rows(spark, a), 20, 4)
    vals, vecs = np.linalg.eigh(a.T @ a)
    assert np.allclose(s, np.sqrt(vals[::-1][:4]), atol=1e-9)
    vv, uu = np.zeros((20, 4)), np.zeros((60, 4))
    for r in v.collect():
        vv[r.term_idx, r.concept] = r.weight
    for r in u.collect():
        uu[r.doc_id, r.concept] = r.weight
    assert np.allclose(abs(vv), abs(vecs[:, ::-1][:, :4]), atol=1e-6)
    assert (vv[abs(vv).argmax(axis=0), range(4)] > 0).all()
    assert np.allclose(uu * s, a @ vv, atol=1e-6)


def test_svd_of_5000_terms(spark):
    """More terms than the block is wide, of rank 6, and of rank below k."""
    import numpy as np
    from quarry.operators import text
    rng = np.random.default_rng(5)
    mask = rng.random((80, 5000)) < 0.02
    a = np.where(mask, rng.normal(size=(80, 5000)), 0.0) * 0.2
    a[:, :60] += rng.normal(size=(80, 6)) * [9, 7, 5, 4, 3, 2] @ rng.normal(size=(6, 60))
    u, v, s = text.svd(_svd_rows(spark, a), 5000, 4)
    want = np.linalg.svd(a, full_matrices=False)
    assert np.allclose(s, want[1][:4], rtol=1e-7)
    vv = np.zeros((5000, 4))
    for r in v.collect():
        vv[r.term_idx, r.concept] = r.weight
    assert np.allclose(abs(vv), abs(want[2][:4].T), atol=1e-5)
    one = np.outer(np.arange(1.0, 9.0), np.ones(30))
    assert len(text.svd(_svd_rows(spark, one), 30, 4)[2]) == 1
    none = spark.createDataFrame([], "doc_id long, term_idx int, tfidf double")
    assert text.svd(none, 0, 4)[2] == []
