"""Compute-or-load: loads without computing, and only what was committed."""

from pyspark.ml.feature import VectorSlicer
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.sources import results

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("n", T.LongType())])


class Sums:
    """A computation that counts its calls."""

    def __init__(self, spark, path, then=None):
        self.spark, self.path, self.calls, self.then = spark, path, 0, then

    def __call__(self):
        self.calls += 1
        out = self.spark.read.schema("k long").parquet(self.path).groupBy("k").agg(F.count(F.lit(1)).cast("int").alias("n"))
        if self.then:
            then, self.then = self.then, None
            out = out.checkpoint()
            then()
        return out


def _source(spark, tmp_path, n=10, mode="overwrite"):
    path = str(tmp_path / "in")
    spark.range(n).select((F.col("id") % 3).alias("k")).coalesce(1).write.mode(mode).parquet(path)
    return path


def _run(spark, path, c, tmp_path, **params):
    df = results.compute_or_load(spark, "sums", [path], SCHEMA, c, str(tmp_path / "out"), **params)
    assert df.schema == SCHEMA
    return sorted(map(tuple, df.collect()))


def test_second_call_reads_no_source(spark, tmp_path):
    path = _source(spark, tmp_path)
    c = Sums(spark, path)
    want = [(0, 4), (1, 3), (2, 3)]
    assert _run(spark, path, c, tmp_path) == want == _run(spark, path, c, tmp_path) and c.calls == 1
    assert _run(spark, path, c, tmp_path, floor=2) == want and c.calls == 2  # other parameters
    _source(spark, tmp_path, 3, "append")  # other inputs
    assert _run(spark, path, c, tmp_path) == [(0, 5), (1, 4), (2, 4)] and c.calls == 3


def test_half_written_folder_is_passed_over(spark, tmp_path):
    path = _source(spark, tmp_path)
    home = tmp_path / "out" / ("sums-" + results.fingerprint(spark, [path], schema=SCHEMA.json()))
    (home / "0lost").mkdir(parents=True)
    (home / "0lost" / "part-0.parquet").write_bytes(b"PAR1 and no more")
    c = Sums(spark, path)
    assert _run(spark, path, c, tmp_path) == [(0, 4), (1, 3), (2, 3)] and c.calls == 1


def test_two_writers_commit_one_result(spark, tmp_path):
    path = _source(spark, tmp_path)
    second = Sums(spark, path)
    first = Sums(spark, path, then=lambda: _run(spark, path, second, tmp_path))
    assert _run(spark, path, first, tmp_path) == [(0, 4), (1, 3), (2, 3)]
    assert (first.calls, second.calls) == (1, 1)
    home, = (tmp_path / "out").iterdir()
    marks = [p.name for p in home.iterdir() if p.name.startswith(results.MARKER)]
    assert len(marks) == 2 and results.committed(spark, str(home)).endswith(min(marks).removeprefix(results.MARKER))


def test_inputs_that_change_meanwhile(spark, tmp_path):
    path = _source(spark, tmp_path)
    c = Sums(spark, path, then=lambda: _source(spark, tmp_path, 3, "append"))
    assert _run(spark, path, c, tmp_path) == [(0, 5), (1, 4), (2, 4)] and c.calls == 2


def test_model_is_loaded(spark, tmp_path):
    def fail():
        raise AssertionError("fitted again")
    made = results.load_or_fit(spark, "cut", "a", VectorSlicer, lambda: VectorSlicer(indices=[1]), str(tmp_path))
    again = results.load_or_fit(spark, "cut", "a", VectorSlicer, fail, str(tmp_path))
    assert made.getIndices() == again.getIndices() == [1]
