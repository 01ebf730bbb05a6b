"""Triangle grid, landmark bitmaps and the bootstrap's tail histogram against
plain versions."""
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import graph, risk


def _graph(spark, n, edges, kind="long"):
    name = (lambda i: f"v{i}") if kind == "string" else int
    v = spark.createDataFrame([(name(i),) for i in range(n)], f"id {kind}")
    e = spark.createDataFrame([(name(a), name(b)) for a, b in edges], f"src {kind}, dst {kind}")
    return v, e, name


def _brute(n, edges):
    near = {i: set() for i in range(n)}
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    return {i: sum(b in near[a] for a, b in itertools.combinations(sorted(near[i]), 2)) for i in range(n)}


@pytest.mark.parametrize("kind,blocks", [("long", 1), ("long", 4), ("string", 3), ("long", None)])
def test_triangles_with_a_hub(spark, monkeypatch, kind, blocks):
    """A hub next to every vertex holds a third of all edges."""
    monkeypatch.setattr(graph, "CELL_WEDGES", 50)
    rng = random.Random(4)
    n = 120
    edges = [(0, i) for i in range(1, n)] + [(rng.randrange(1, n), rng.randrange(1, n)) for _ in range(240)]
    edges += edges[:40] + [(b, a) for a, b in edges[40:80]]
    v, e, name = _graph(spark, n, edges, kind)
    got = {r["id"]: r["triangles"] for r in graph.triangle_count(v, e, blocks).collect()}
    assert got == {name(i): t for i, t in _brute(n, edges).items()}


def test_triangles_shuffle_no_wedges(spark):
    """A star of 2,000 leaves has 2 million wedges; a cell's rows are edges only."""
    v, e, _ = _graph(spark, 2001, [(0, i) for i in range(1, 2001)])
    t = graph.triangle_count(v, e, 3)
    assert "FlatMapGroupsInArrow" in t._jdf.queryExecution().executedPlan().toString()
    assert t.agg(F.sum("triangles")).first()[0] == 0


def test_no_edges(spark):
    v, e, _ = _graph(spark, 3, [])
    assert {r["triangles"] for r in graph.triangle_count(v, e).collect()} == {0}
    assert graph.landmark_distances(v, e).count() == 3


def test_landmarks_grow_with_the_vertices(spark):
    from quarry.functions.expr import hash_uniform
    from quarry.plans.queries import graph as queries
    v = spark.range(4000).select("id")
    share = {r["id"] for r in v.where(hash_uniform(F.col("id"), F.lit(1)) < 0.05).collect()}
    marks = [r["id"] for r in graph.sample_landmarks(v, queries.LEAST, 1, queries.SHARE).collect()]
    assert len(share) > 150 and len(marks) == len(set(marks)) and set(marks) == share
    assert graph.sample_landmarks(v.where("id < 300"), queries.LEAST, 1, queries.SHARE).count() == 64


@pytest.mark.parametrize("sweep", [256, 70, 3])
def test_landmark_hops(spark, monkeypatch, sweep):
    monkeypatch.setattr(graph, "SWEEP", sweep)
    rng = random.Random(8)
    n = 90
    edges = [(i, i + 1) for i in range(30)] + [(rng.randrange(n), rng.randrange(n)) for _ in range(60)]
    v, e, _ = _graph(spark, n, edges)
    lm = graph.sample_landmarks(v, 7 if sweep == 3 else 75, seed=1)
    marks = {r["id"] for r in lm.collect()}
    want = {}
    out = {i: {b for a, b in edges if a == i} for i in range(n)}
    for m in marks:
        level, d, seen = {m}, 0, {m}
        while level:
            for x in level:
                want[x, m] = d
            level = {y for x in level for y in out[x]} - seen
            seen |= level
            d += 1
    got = {(r["id"], r["landmark"]): r["dist"] for r in graph.landmark_distances(lm, e).collect()}
    assert got == want
    maps = {r["id"]: r["map"] for r in graph.landmark_maps(v, lm, e).collect()}
    assert len(maps) == n and all(maps[i] == {m: d for (x, m), d in want.items() if x == i} for i in range(n))
    pregel = {r["id"]: r["map"] for r in graph.landmark_maps_pregel(v, e, lm).collect()} if sweep == 3 else maps
    assert pregel == maps


@pytest.mark.parametrize("share", [0.06, 0.002, 0.7])
def test_bootstrap_against_copies(spark, share):
    """Ties, outliers and too small a first share (the histogram is widened)."""
    rng = np.random.default_rng(3)
    v = np.concatenate([np.round(rng.normal(size=500), 1), [-1e6, 1e6, -3.0, -3.0]])
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(v)] + [(9999, None), (9998, float("nan"))], "trial long, ret double")
    got = {r["replicate"]: r for r in risk.bootstrap_var_cvar(df, 12, share=share).collect()}
    w = df.select("trial", risk._draws(F.col("trial"), 12, 7).alias("w")).where("trial < 9000").orderBy("trial").collect()
    for g in range(12):
        copies = np.sort(np.repeat(v, [r["w"][g] for r in w]))
        k = max(len(copies) // 20, 1)
        assert got[g]["var"] == copies[k - 1]
        assert np.isclose(got[g]["cvar"], copies[:k].mean(), rtol=1e-12)


def test_bootstrap_of_few_rows(spark):
    one = spark.createDataFrame([(1, 2.5)], "trial long, ret double")
    got = risk.bootstrap_var_cvar(one, 20).collect()
    assert 0 < len(got) < 20 and {(r["var"], r["cvar"]) for r in got} == {(2.5, 2.5)}
    assert risk.bootstrap_var_cvar(one.limit(0), 20).collect() == []


def _geojson(spark, features):
    import json

    from quarry.session import shared_dir
    from quarry.sources import formats
    path = shared_dir(spark, "zones-test")
    feats = [{"type": "Feature", "properties": {"boroughCode": str(c), "borough": n}, "geometry": {"type": kind, "coordinates": xy}}
             for c, n, kind, xy in features]
    spark.createDataFrame([(json.dumps({"type": "FeatureCollection", "features": feats}, indent=1),)], "value string") \
        .coalesce(1).write.text(path)
    return formats.geojson_zones(spark, path)


def _inside(x, y, rings):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
    return odd


@pytest.mark.parametrize("cell", [None, 3.0, 0.7, 500.0])
def test_zones_with_holes_and_parts(spark, cell):
    """Holes, several parts, an island in a hole, a ring of many edges, a repeated feature: even-odd
    over all rings, first zone by (code, area)."""
    from quarry.operators import trips
    rng = random.Random(6)
    square = lambda a, b, c, d: [[a, b], [c, b], [c, d], [a, d], [a, b]]
    round_ = [[50 + 30 * np.cos(t), 60 + 25 * np.sin(t) * (1 + 0.1 * np.sin(9 * t))] for t in np.linspace(0, 6.28, 400)]
    feats = [(2, "ring", "Polygon", [square(0, 0, 40, 40), square(10, 10, 30, 30)]),
             (3, "island", "Polygon", [square(15, 15, 25, 25)]),
             (1, "two", "MultiPolygon", [[square(50, 0, 60, 10)], [square(70, 0, 95, 20), square(75, 5, 80, 15)]]),
             (4, "blob", "Polygon", [[list(map(float, p)) for p in round_], square(45, 55, 52, 66)]),
             (5, "all", "Polygon", [square(-5, -5, 100, 100)]), (5, "all", "Polygon", [square(-5, -5, 100, 100)]),
             (0, "none", "Point", [1.0, 2.0])]
    z = _geojson(spark, feats)
    assert {(r["zone"], round(r["area"])) for r in z.collect()} >= {("ring", 1200), ("two", 550)}
    points = [(i, (rng.uniform(-8, 104), rng.uniform(-8, 104))) for i in range(1500)]
    points += [(2000 + i, p) for i, p in enumerate([(10.0, 10.0), (30.0, 20.0), (0.0, 0.0), (40.0, 40.0), (75.0, 10.0), (60.0, 5.0)])]
    t = spark.createDataFrame(points, "trip_id long, dropoff_loc struct<x:double,y:double>")
    got = {r["trip_id"]: r["zone"] for r in trips.assign_zone(t, z, cell=cell).collect()}
    rings = sorted((c, n, sum(xy, []) if kind == "MultiPolygon" else xy) for c, n, kind, xy in feats if kind != "Point")
    want = {i: next((n for _, n, r in rings if _inside(x, y, r)), "NA") for i, (x, y) in points}
    assert got == want and len(set(want.values())) == 6


@pytest.mark.parametrize("size", [(7, 5), (2048, 2048)])
def test_top_n_of_all_users(spark, monkeypatch, size):
    """Exact against all scores, with repeated item vectors, zero vectors and users who saw nearly all."""
    from quarry.operators import recommend
    monkeypatch.setattr(recommend, "ITEM_BLOCK", size[0])
    monkeypatch.setattr(recommend, "USER_BLOCK", size[1])
    rng = np.random.default_rng(9)
    items = rng.integers(-4, 5, (90, 4)).astype(float) * rng.integers(1, 6, (90, 1))
    items[50:60] = items[0]
    users = rng.integers(-4, 5, (33, 4)).astype(float)
    users[3] = items[70] = 0.0

    class Model:
        itemFactors = spark.createDataFrame([(i + 1, x.tolist()) for i, x in enumerate(items)], "id int, features array<float>")
        userFactors = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(users)], "id int, features array<float>")
    seen = [(u, i + 1) for u in range(33) for i in range(90) if rng.random() < 0.2 or (u == 5 and i > 2)]
    saw = spark.createDataFrame(seen, "user long, item long")
    got = [(r["user"], r["rank"], r["item"], r["score"]) for r in recommend.top_n_for_users(Model, None, saw, 5).collect()]
    want = []
    for u in range(33):
        free = sorted((-float(users[u] @ items[i - 1]), i) for i in range(1, 91) if (u, i) not in set(seen))[:5]
        want += [(u, k + 1, i, -s + 0.0) for k, (s, i) in enumerate(free)]
    assert sorted(got) == sorted(want)
    some = spark.createDataFrame([(4,), (4,), (77,)], "user long")
    assert {r["user"] for r in recommend.top_n_for_users(Model, some, saw, 5).collect()} == {4}
