import random

import pytest
from pyspark.sql import functions as F

from dealcast.operators import metrics as E
from dealcast.operators import models as M


def _planted(spark, n=600, seed=4):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, noise = rnd.random(), rnd.random(), rnd.random()
        y = int(a + 0.3 * noise > 0.75)
        rows.append(("x" if i % 2 else "z", i, a, b, y, 0.4 * a + 0.05 * noise))
    return spark.createDataFrame(rows, "brand string, id int, a double, b double, y int, t double")


def test_label_never_a_feature(spark):
    df = _planted(spark)
    with pytest.raises(AssertionError):
        M.vector_frame(df, ["a", "b", "y"], "y")


def test_classifiers_beat_constant_on_planted_signal(spark):
    vf, _ = M.vector_frame(_planted(spark), ["a", "b"], "y", keep=["id"])
    tr, te = vf.where(F.col("id") % 3 != 0), vf.where(F.col("id") % 3 == 0)
    for name in ("logit", "random_forest", "naive_bayes"):
        p = M.positive_score(M.fit_predict(tr, te, M.CLASSIFIERS[name](7)), name)
        auc = E.auroc(p.select(F.lit(name).alias("m"), F.col("label").alias("y"), "score"), ["m"]).first().auroc
        assert auc > 0.8, (name, auc)


@pytest.mark.parametrize("only", [0, 1])
def test_classifiers_of_one_class_predict_it(spark, only):
    vf, _ = M.vector_frame(_planted(spark), ["a", "b"], "y", keep=["id"])
    tr, te = (M.binary_label(vf.where(F.col("id") % 3 == r)) for r in (0, 1))
    tr = tr.where(F.col("label") == only)
    preds = {name: M.fit_predict(tr, te, make(7)) for name, make in M.CLASSIFIERS.items()} | {"kbest": M.kbest_logit(tr, te, 1)}
    for name, pred in preds.items():
        assert pred.count() == te.count(), name
        assert {r.prediction for r in pred.collect()} == {float(only)}, name
        limit = 0.5 if "probability" in pred.columns else 0.0
        assert {r.score >= limit for r in M.positive_score(pred, name).collect()} == {bool(only)}, name


def test_trend_models_recover_slope(spark):
    rows = [("b", float(x), 0.1 + 0.002 * x) for x in range(200)]
    df = spark.createDataFrame(rows, "brand string, x double, y double")
    ols = M.ols_trend(df, "x", "y", ["brand"]).first()
    assert abs(ols.slope - 0.002) < 1e-12 and abs(ols.intercept - 0.1) < 1e-9
    br = M.bayes_trend(df, "x", "y", ["brand"]).first()
    assert abs(br.slope - 0.002) < 1e-6
    lasso = M.lasso_trend(df, "x", "y", ["brand"], alpha=10.0).first()
    assert lasso.slope == 0.0


def test_adaboost_and_extra_trees_fit(spark):
    df = _planted(spark)
    vf, _ = M.vector_frame(df, ["a", "b"], "t", keep=["id", "a", "b"])
    tr, te = vf.where(F.col("id") % 3 != 0), vf.where(F.col("id") % 3 == 0)
    for pred in (M.adaboost_r2(tr, te, n_estimators=4), M.extra_trees(tr, te, ["a", "b"], n_trees=4)):
        e = pred.select(F.sqrt(F.avg((F.col("prediction") - F.col("label")) ** 2)).alias("r"),
                        F.stddev_pop("label").alias("s")).first()
        assert e.r < e.s  # beats predicting the mean
