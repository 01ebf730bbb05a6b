"""Classification queries on the cover-type stand-in."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import classify
from quarry.plans import roles
from quarry.plans.registry import query


def _cover(spark, d):
    """0-based label, split column, decoded categories."""
    c = roles.cover_file(spark, d).withColumn("label", (F.col("label") - 1).cast("double"))
    c = c.withColumn("split", roles.split_of())
    return c


def _decoded(spark, d):
    return classify.decode_onehot(_cover(spark, d), {"wilderness": roles.WILD, "soil": roles.SOIL})


@query("onehot_decode")
def onehot_decode(spark, d):
    x = _decoded(spark, d)
    return x.select("vec_id", F.col("label").cast("int").alias("label"), "wilderness", "soil")


@query("class_priors")
def class_priors(spark, d):
    p = classify.class_priors(_cover(spark, d))
    return p.select(F.col("label").cast("int").alias("label"), F.round("prior", 6).alias("prior"))


@query("random_baseline")
def random_baseline(spark, d):
    c = _cover(spark, d)
    a = classify.random_guess_accuracy(c.where(F.col("split") == "train"), c.where(F.col("split") == "cv"))
    return a.select(F.round("accuracy", 6).alias("accuracy"))


def _numeric(spark, d):
    c = _cover(spark, d)
    # read by several fits: cut lineage into the shared folder (no executor memory held)
    return classify.assemble(c, roles.NUMERIC + roles.WILD + roles.SOIL).checkpoint()


@query("confusion")
def confusion(spark, d):
    """Decision tree (gini, depth 4, 100 bins) scored on the validation split."""
    x = _numeric(spark, d)
    m = classify.tree("gini", 4, 100).fit(x.where(F.col("split") == "train"))
    return classify.confusion(m.transform(x.where(F.col("split") == "cv").select("label", "features")))


@query("class_metrics")
def class_metrics(spark, d):
    x = _numeric(spark, d)
    m = classify.tree("gini", 4, 100).fit(x.where(F.col("split") == "train"))
    return classify.precision_recall(m.transform(x.where(F.col("split") == "cv").select("label", "features")))


@query("tree_grid")
def tree_grid(spark, d):
    """impurity {gini, entropy} x depth {1, 20} x bins {10, 300}, numeric features."""
    x = _numeric(spark, d)
    grid = [dict(impurity=i, depth=dp, bins=b) for i in ("gini", "entropy") for dp in (1, 20) for b in (10, 300)]
    tr, cv, te = (x.where(F.col("split") == k) for k in ("train", "cv", "test"))
    g = classify.grid_eval(tr, cv, grid, classify.tree)
    # then entropy / depth 20 / 300 bins refitted on train + cv: fit and test accuracy
    refit = classify.refit_score(tr, cv, te, classify.tree("entropy", 20, 300), "refit entropy/20/300 (test)")
    return g.unionByName(refit)


def _categorical(spark, d):
    from pyspark.ml.feature import VectorIndexer
    x = classify.assemble(_decoded(spark, d), roles.NUMERIC + ["wilderness", "soil"], "raw")
    vi = VectorIndexer(inputCol="raw", outputCol="features", maxCategories=40).fit(x)
    return vi.transform(x).checkpoint()


@query("tree_grid_categorical")
def tree_grid_categorical(spark, d):
    """Decoded categories marked categorical: {gini, entropy} x depth {10, 20, 30} x bins {40, 300}."""
    x = _categorical(spark, d)
    grid = [dict(impurity=i, depth=dp, bins=b) for i in ("gini", "entropy") for dp in (10, 20, 30)
            for b in (40, 300)]
    tr, cv, te = (x.where(F.col("split") == k) for k in ("train", "cv", "test"))
    g = classify.grid_eval(tr, cv, grid, classify.tree)
    refit = classify.refit_score(tr, cv, te, classify.tree("entropy", 30, 300), "refit entropy/30/300 (test)")
    return g.unionByName(refit)


@query("forest")
def forest(spark, d):
    """Random forest (20 trees, entropy, depth 30, 300 bins): validation
    accuracy, and the prediction for one validation row."""
    x = _categorical(spark, d)
    m = classify.forest().fit(x.where(F.col("split") == "train"))
    p = m.transform(x.where(F.col("split") == "cv").select("vec_id", "label", "features"))
    acc = p.agg(classify.accuracy().alias("value")).select(F.lit("cv_accuracy").alias("metric"), "value")
    one = (p.orderBy("vec_id").limit(1)
           .select(F.concat(F.lit("prediction_vec_"), F.col("vec_id").cast("string")).alias("metric"),
                   F.col("prediction").alias("value")))
    return acc.unionByName(one)


@query("logreg")
def logreg(spark, d):
    """Elastic-net logistic regression (10 iterations, reg 0.3, alpha 0.8):
    the coefficient matrix as (class, feature, coef) plus intercepts."""
    x = _numeric(spark, d)
    m = classify.logreg(10, 0.3, 0.8).fit(x.where(F.col("split") != "test"))
    rows = m.coefficientMatrix.toArray()
    ic = m.interceptVector.toArray()
    data = [(int(k), int(j), float(rows[k, j])) for k in range(rows.shape[0]) for j in range(rows.shape[1])]
    data += [(int(k), -1, float(ic[k])) for k in range(len(ic))]
    return spark.createDataFrame(data, "class int, feature int, coef double")
