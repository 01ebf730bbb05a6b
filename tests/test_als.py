"""The ALS of several models at once, against pyspark.ml's from the same first factors."""
import numpy as np
import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from quarry.operators import als, recommend


def plays(n=900, users=60, items=45, models=2):
    rng = np.random.default_rng(5)
    # a user of many plays, and plays of no and of negative count
    rows = {(m, int(u), int(i)): float(c) for m in range(models) for u, i, c in zip(
        np.r_[rng.integers(0, users, n), np.zeros(40, int)], np.r_[rng.integers(0, items, n), np.arange(40)],
        np.r_[rng.integers(-2, 9, n), np.ones(40, int)])}
    return [(*k, c) for k, c in rows.items()]


def table_of(df):
    return {(r["model"], r["id"]): np.array(r["f"]) for r in df.collect()}


@pytest.mark.parametrize("rank, reg, alpha", [(3, 0.001, 40.0), (7, 1.0, 1.0)])
def test_as_pyspark_ml(spark, monkeypatch, rank, reg, alpha):
    monkeypatch.setattr(als, "CELLS", 64)   # rows of more plays than a batch holds
    monkeypatch.setattr(als, "SENT_ROWS", 5)
    monkeypatch.setattr(als, "HELD_ROUNDS", 1)
    rows = plays()
    df = spark.createDataFrame(rows, "model int, user int, item int, count float")
    settings = dict(rank=rank, regParam=reg, alpha=alpha, implicitPrefs=True, seed=1, numUserBlocks=2, numItemBlocks=2,
                    userCol="user", itemCol="item", ratingCol="count")
    want, begin = {}, {}
    for m in (0, 1):
        one = df.where(F.col("model") == m)
        begin |= {(m, r["id"]): list(r["features"]) for r in ALS(maxIter=0, **settings).fit(one).userFactors.collect()}
        model = ALS(maxIter=4, **settings).fit(one)
        want |= {(side, m, r["id"]): np.array(r["features"]) for side in ("userFactors", "itemFactors")
                 for r in getattr(model, side).collect()}
    got = als.fit(als.lay_out(df, 3), 3, rank, reg, alpha, 4, lambda m, ids, _: np.array([begin[m, int(i)] for i in ids]))
    got = {(side, *k): f for side, d in zip(("userFactors", "itemFactors"), got) for k, f in table_of(d).items()}
    assert got.keys() == want.keys()
    for k, f in want.items():
        assert np.allclose(got[k], f, rtol=2e-3, atol=2e-4), k


def test_blocks_do_not_matter(spark):
    df = spark.createDataFrame(plays(), "model int, user int, item int, count float")
    one, three = (als.fit(als.lay_out(df, b), b, 4, 0.1, 2.0, 3, als.unit_normals(1)) for b in (1, 3))
    for a, b in zip(one, three):
        a, b = table_of(a), table_of(b)
        assert a.keys() == b.keys() and all(np.allclose(a[k], b[k], rtol=1e-3, atol=1e-4) for k in a)


def test_rows_without_plays_above_zero(spark):
    df = spark.createDataFrame([(0, 0, 0, 2.0), (0, 0, 1, 1.0), (0, 1, 2, 0.0), (0, 2, 0, 3.0)],
                               "model int, user int, item int, count float")
    users, items = (table_of(d) for d in als.fit(als.lay_out(df, 2), 2, 2, 0.1, 1.0, 2, als.unit_normals(1)))
    assert not users[0, 1].any() and not items[0, 2].any() and users[0, 0].any()


def ratings(spark, rows):
    return spark.createDataFrame(rows, "user int, item int, count float, fold int").checkpoint()


def test_a_setting_is_fitted_once_for_all_folds(spark):
    """The grid's means are those of each fold on its own; fits are not made fold by fold."""
    rng = np.random.default_rng(2)
    rows = list({(u, i): (u, i, float(rng.integers(1, 6)), int(rng.integers(0, 3)))
                 for u, i in zip(rng.integers(0, 12, 150).tolist(), rng.integers(0, 30, 150).tolist())}.values())
    r, asked = ratings(spark, rows), []

    def popular(plays, by):
        return plays.groupBy(*by, "item").agg(F.sum("count").cast("double").alias("score"))

    def fitter(train, models):
        assert models == [0, 1, 2]
        asked.append("plays")

        def fit(setting):
            asked.append(setting)
            seen = popular(train.withColumnRenamed("model", "fold"), ["fold"])
            return lambda _, pairs: (pairs.join(seen, ["fold", "item"], "left").na.fill(0.0, ["score"])
                                     .withColumn("score", F.col("score") * setting))
        return fit
    got = recommend.folds_auc(r, [1, -1], fitter, folds=3, seed=4)
    assert asked[0] == "plays" and sorted(asked[1:]) == [-1, 1]
    neg = recommend.sample_negatives(r, r.select("item"), seed=4, group=("fold", "user"))
    for setting, mean in zip((1, -1), got):
        folds = []
        for f in range(3):
            seen = popular(r.where(F.col("fold") != f), [])
            score = lambda _, pairs, seen=seen, s=setting: (pairs.join(seen, "item", "left").na.fill(0.0, ["score"])
                                                            .withColumn("score", F.col("score") * s))
            one = r.where(F.col("fold") == f)
            folds.append(recommend.area_under_curve(one, one, r.select("item"), score, group=("fold", "user"),
                                                    negatives=neg.where(F.col("fold") == f)).agg(F.avg("auc")).first()[0])
        assert mean == pytest.approx(sum(folds) / 3)


def test_fold_without_plays_outside(spark):
    r = ratings(spark, [(0, 0, 1.0, 1), (1, 1, 1.0, 1), (1, 2, 1.0, 1)])
    assert recommend.folds_auc(r, [1], lambda *_: pytest.fail("nothing to fit"), folds=3) == [None]


def test_factor_scorer(spark):
    users = spark.createDataFrame([(0, 1, [1.0, 2.0]), (1, 1, [3.0, 0.5])], "model int, id int, f array<float>")
    items = spark.createDataFrame([(0, 7, [0.5, 1.0]), (1, 8, [1.0, 1.0])], "model int, id int, f array<float>")
    pairs = spark.createDataFrame([(0, 1, 7, 1), (0, 1, 8, 0), (1, 1, 8, 1), (1, 2, 8, 0)], "fold int, user int, item int, is_pos int")
    got = recommend.factor_scorer(users, items, 2)(None, pairs).collect()
    assert {(r["fold"], r["user"], r["item"], r["is_pos"]): r["score"] for r in got} == {
        (0, 1, 7, 1): 2.5, (0, 1, 8, 0): 0.0, (1, 1, 8, 1): 3.5, (1, 2, 8, 0): 0.0}
