"""A round of connected components costs few shuffles and leaves few files."""

import os

from quarry.operators.graph import connected_components
from quarry.session import shared_dir


def _shuffles(spark) -> int:
    return spark.sparkContext._jsc.sc().newShuffleId()


def test_rounds_shuffle_little_and_remove_their_tables(spark):
    edges = [(i, i + 1) for i in range(40)] + [(50, 60), (60, 50), (70, 70), (None, 3)]
    e = spark.createDataFrame(edges, "src long, dst long")
    v = spark.createDataFrame([(i,) for i in range(80)], "id long")
    top = shared_dir(spark).removeprefix("file:")
    before, there = _shuffles(spark), set(os.listdir(top))
    got = {r["id"]: r["component"] for r in connected_components(v, e).collect()}
    assert got == {i: 0 if i <= 40 else 50 if i == 60 else i for i in range(80)}
    assert _shuffles(spark) - before < 40
    assert len(set(os.listdir(top)) - there) == 1   # the table that the result reads
