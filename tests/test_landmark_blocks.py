"""Landmark search in blocks of vertices: many landmarks at a time, any blocks, sweeps and ids."""
import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import graph


def _case(spark, n, degree, name):
    rng = random.Random(11)
    edges = [(i, rng.randrange(n)) for i in range(n - 5) for _ in range(degree)]   # five vertices without edges out
    near = {i: {b for a, b in edges if a == i} for i in range(n)}
    want = {}
    for m in range(n):
        level, d, seen = {m}, 0, {m}
        while level:
            want |= {(name(x), name(m)): d for x in level}
            level = {y for x in level for y in near[x]} - seen
            seen |= level
            d += 1
    kind = "long" if name is int else "string"
    return (spark.createDataFrame([(name(i),) for i in range(n)], f"id {kind}"),
            spark.createDataFrame([(name(a), name(b)) for a, b in edges], f"src {kind}, dst {kind}"), want)


def _counted(monkeypatch):
    written, kept = [], graph._ckpt
    monkeypatch.setattr(graph, "_ckpt", lambda df: written.append(df.columns) or kept(df))
    return written


def test_many_landmarks_take_few_rounds(spark, monkeypatch):
    """600 landmarks were three sweeps, each with rounds of its own over all edges."""
    v, e, want = _case(spark, 600, 6, int)
    written = _counted(monkeypatch)
    got = graph.landmark_distances(v, e)
    assert {(r["id"], r["landmark"]): r["dist"] for r in got.collect()} == want
    assert got.dtypes == [("id", "bigint"), ("landmark", "bigint"), ("dist", "int")]
    assert len(written) <= 5 + max(want.values()) + 1


@pytest.mark.parametrize("sweep, edges, words", [(64, 20, 50), (100, 4_000_000, 1 << 20)])
def test_blocks_and_sweeps_of_names(spark, monkeypatch, sweep, edges, words):
    monkeypatch.setattr(graph, "SWEEP", sweep)
    monkeypatch.setattr(graph, "BLOCK_EDGES", edges)
    monkeypatch.setattr(graph, "WORDS", words)
    v, e, want = _case(spark, 130, 2, lambda i: f"v{i:03d}")
    got = graph.landmark_distances(v, e).collect()
    assert len(got) == len(want) and {(r["id"], r["landmark"]): r["dist"] for r in got} == want


def test_maps_are_merged_once(spark, monkeypatch):
    """Each sweep used to merge every vertex's whole map again."""
    monkeypatch.setattr(graph, "SWEEP", 10)
    v, e, want = _case(spark, 40, 2, int)
    m = graph.landmark_maps(v.unionByName(spark.createDataFrame([(99,)], "id long")), v, e)
    plan = m._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("map_zip_with") == 1
    got = {r["id"]: r["map"] for r in m.collect()}
    assert got.pop(99) == {} and {(i, k): d for i, x in got.items() for k, d in x.items()} == want


def test_no_landmarks(spark):
    v, e, _ = _case(spark, 20, 2, int)
    assert graph.landmark_distances(v.where(F.col("id") < 0), e).count() == 0
