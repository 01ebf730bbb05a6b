"""Trees against pyspark.ml's, with large nodes split by histograms and
subtrees grown in tasks."""

import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler, VectorIndexer
from pyspark.sql import functions as F

from quarry.operators import classify, trees


@pytest.fixture(scope="module")
def rows(spark):
    """Two values, a category of 3 and one of 12, four noisy classes."""
    h = lambda seed, n: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n))
    df = spark.range(900).select(
        "id", (h(1, 1000) / 10.0).alias("a"), (h(2, 40) * 1.0).alias("b"), (h(3, 3) * 1.0).alias("c"), (h(4, 12) * 1.0).alias("d"))
    noisy = F.when(h(5, 4) == 0, h(6, 4)).otherwise(F.pmod(F.floor(F.col("a") / 30) + F.col("c") + F.floor(F.col("d") / 5), F.lit(4)))
    df = VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="raw").transform(df.withColumn("label", noisy.cast("double")))
    x = VectorIndexer(inputCol="raw", outputCol="features", maxCategories=12).fit(df).transform(df)
    return x.select("id", "label", "features").localCheckpoint()


def _predictions(model, df):
    return {r["id"]: r["prediction"] for r in model.transform(df).select("id", "prediction").collect()}


@pytest.mark.parametrize("impurity,depth,bins", [("gini", 20, 40), ("entropy", 6, 16), ("gini", 1, 300), ("entropy", 0, 40)])
@pytest.mark.parametrize("few", [60, 100_000])
def test_tree_is_that_of_pyspark_ml(rows, monkeypatch, impurity, depth, bins, few):
    monkeypatch.setattr(trees, "MOST_ROWS", few)
    want = DecisionTreeClassifier(impurity=impurity, maxDepth=depth, maxBins=bins, seed=1).fit(rows)
    got = classify.tree(impurity, depth, bins).fit(rows)
    assert (len(got.subs) > 4) == (few == 60 and depth > 5)
    assert _predictions(got, rows) == _predictions(want, rows)


def test_fit_needs_few_jobs_however_many_nodes(rows, spark):
    """pyspark.ml passes over the rows for every few nodes of 300 bins; here
    the nodes below the bound are grown in one pass."""
    wide = rows.withColumn("label", F.pmod(F.xxhash64("id"), F.lit(8)).cast("double")).localCheckpoint()
    spark.sparkContext.setJobGroup("trees", "trees")
    model = classify.tree("gini", 30, 300).fit(wide)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("trees"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 30
    assert model.transform(wide).where("label <> prediction").count() == 0   # grown until every leaf is pure


@pytest.mark.parametrize("few", [60, 100_000])
def test_forest(rows, monkeypatch, few):
    monkeypatch.setattr(trees, "MOST_ROWS", few)
    train, rest = rows.where("id % 10 < 8"), rows.where("id % 10 >= 8")
    one = _predictions(classify.forest(5, depth=12, bins=40).fit(train), rest)
    again = _predictions(classify.forest(5, depth=12, bins=40).fit(train), rest)
    assert one == again and len(one) == rest.count()
    # draws differ from pyspark.ml's, so only the accuracy can be compared: of twenty trees each
    labels = {r["id"]: r["label"] for r in rest.collect()}
    right = lambda p: sum(p[i] == labels[i] for i in labels) / len(labels)
    ours = right(_predictions(classify.forest(20, depth=12, bins=40).fit(train), rest))
    theirs = right(_predictions(RandomForestClassifier(
        numTrees=20, impurity="entropy", maxDepth=12, maxBins=40, seed=1).fit(train), rest))
    assert abs(ours - theirs) < 0.1 and ours > 0.4, (ours, theirs)   # chance: a quarter


def test_a_subtree_that_many_rows_reach_goes_to_several_tasks(rows, monkeypatch):
    model = classify.tree("gini", 20, 40).fit(rows)
    want = _predictions(model, rows)
    monkeypatch.setattr(trees, "MOST_ROWS", 50)
    assert _predictions(model, rows) == want


def test_odd_inputs(rows):
    with pytest.raises(ValueError, match="no rows"):
        classify.tree().fit(rows.limit(0))
    one_class = rows.withColumn("label", F.lit(2.0))
    model = classify.tree("gini", 5, 40).fit(one_class)
    assert {r["prediction"] for r in model.transform(rows).collect()} == {2.0}
    assert model.transform(rows.limit(0)).count() == 0
