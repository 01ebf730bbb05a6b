"""Negatives drawn inside rows are those of the rounds."""

from pyspark.sql import functions as F

from quarry.operators import recommend


def test_draws_in_rows_are_those_of_the_rounds(spark, monkeypatch):
    # users of 1 to 60 positives among 70 items: some first draws do not do; one item is unknown
    pos = spark.range(1, 61).select(F.col("id").alias("user"), F.explode(F.sequence(F.lit(1), F.col("id"))).alias("item"))
    pos = pos.unionByName(spark.createDataFrame([(3, 999), (61, None)], "user long, item int"))
    items = spark.range(1, 71).select(F.col("id").cast("int").alias("item"))
    got = {}
    for most in (0, 8, 128):
        monkeypatch.setattr(recommend, "ROW_POSITIVES", most)
        got[most] = sorted(tuple(r) for r in recommend.sample_negatives(pos, items, seed=4).collect())
    assert got[0] == got[8] == got[128]
    own = {tuple(r) for r in pos.collect()}
    assert not own & set(got[128]) and sum(u == 3 for u, _ in got[128]) == 4


def test_small_groups_need_no_rounds(spark, monkeypatch):
    """Each round shuffles every draw; groups of few positives draw inside a row."""
    pos = spark.range(200).select((F.col("id") % 20).alias("user"), (F.col("id") * 7).cast("int").alias("item"))
    items = spark.range(20_000).select(F.col("id").cast("int").alias("item"))

    def no_rounds(*_a, **_k):
        raise AssertionError("a round was needed")
    monkeypatch.setattr(recommend.ordered, "running_sum", no_rounds)
    assert recommend.sample_negatives(pos, items).count() == 200


def test_auc_in_rows_is_that_of_windows(spark, monkeypatch):
    x = spark.range(3000).select(F.pmod(F.xxhash64("id"), F.lit(40)).alias("user"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(9)) - 4.0)
                                 .alias("score"), (F.col("id") % 3 == 0).alias("p"))
    x = x.unionByName(spark.createDataFrame([(50, 1.0, True), (51, 1.0, False), (52, 0.0, True), (52, -0.0, False)], x.schema))
    pos, neg = x.where("p").drop("p"), x.where("not p").drop("p")
    got = {}
    for most in (0, 100, 100_000):
        monkeypatch.setattr(recommend, "ROW_SCORES", most)
        monkeypatch.setattr(recommend, "COUNT_BUCKETS", 30)
        got[most] = sorted((r["user"], round(r["auc"], 12)) for r in recommend.auc_per_user(pos, neg).collect())
    assert got[0] == got[100] == got[100_000] and len(got[0]) == 41
    assert dict(got[0])[52] == 0.0


def test_auc_of_small_groups_needs_no_windows(spark, monkeypatch):
    def none(*_a, **_k):
        raise AssertionError("windows over all scores")
    monkeypatch.setattr(recommend.ordered, "running_sum", none)
    s = spark.range(100).select((F.col("id") % 10).alias("user"), F.col("id").cast("double").alias("score"))
    assert recommend.auc_per_user(s, s).count() == 10
