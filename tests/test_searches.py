"""Searches, spot checks and folds on planted signal."""

import datetime as dt
import math
import random

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from dealcast.functions.draws import uniform_draw
from dealcast.operators import features as X
from dealcast.operators import models as M


@pytest.fixture(scope="module")
def days(spark):
    """Two brands of different spans; label y follows x1, target t follows x1 and x2."""
    rnd, rows = random.Random(3), []
    for brand, first, n in (("a", 0, 400), ("b", 150, 250)):
        for i in range(n):
            x1, x2 = rnd.random(), rnd.random()
            rows.append((brand, dt.date(2020, 1, 1) + dt.timedelta(first + i), i, x1, x2, int(x1 + 0.1 * rnd.random() > 0.6),
                         math.floor(4 * x1) + 0.2 * x2))
    return spark.createDataFrame(rows, "brand string, posted_date date, id int, x1 double, x2 double, y int, t double")


@pytest.fixture(scope="module")
def regression(days):
    return M.vector_frame(days, ["x1", "x2"], "t", keep=["posted_date"])[0].persist()


@pytest.fixture(scope="module")
def classes(days):
    df = days.withColumns({"fold": F.col("id") % 3, "row_id": F.concat_ws("|", "brand", "id")})
    return M.vector_frame(df, ["x1", "x2"], "y", keep=["fold", "row_id"])[0].persist()


def rmse(pred):
    return RegressionEvaluator(metricName="rmse").evaluate(pred)


def test_calendar_folds_never_train_on_later_days(regression):
    folds = M.calendar_folds(regression, 5, 30)
    last = dt.date(2020, 1, 1) + dt.timedelta(399)
    for f, (train, test) in enumerate(folds):
        tr, te = ([r.posted_date for r in regression.where(side).collect()] for side in (train, test))
        start = last - dt.timedelta(30 * (5 - f) - 1)
        assert max(tr) < start <= min(te) and max(te) == start + dt.timedelta(29)
        assert len(te) == 60  # both brands, one block
    with pytest.raises(ValueError, match="no training day"):
        M.calendar_folds(regression, 20, 84)


@pytest.mark.parametrize("options", [{}, {"bootstrap": True}, {"featureSubsetStrategy": "onethird", "numTrees": 10}])
def test_extra_trees_follow_the_signal(regression, options):
    train, test = regression.where("posted_date < '2020-12-01'"), regression.where("posted_date >= '2020-12-01'")
    est = M.ExtraTreesRegressor(**{"numTrees": 20, **options})
    model = est.fit(train)
    assert model.grown.n_trees == est.getOrDefault(est.numTrees) == len({t for t, _ in model.grown.values})
    pred = model.transform(test)
    sd = test.agg(F.stddev_pop("label")).first()[0]
    assert rmse(pred) < 0.5 * sd
    assert pred.agg(F.sum("prediction")).first() == est.fit(train).transform(test).agg(F.sum("prediction")).first()


def test_extra_trees_of_constant_features(spark, regression):
    flat = regression.select("brand", "posted_date", "features", F.lit(2.5).alias("label"))
    assert rmse(M.ExtraTreesRegressor(numTrees=3).fit(flat).transform(flat)) < 1e-9


def test_walk_forward_search_prefers_the_right_depth(regression):
    tree = DecisionTreeRegressor(seed=1)
    folds = M.calendar_folds(regression, 3, 40)
    (best, score), results = M.walk_forward_search(regression, [(tree, {tree.maxDepth: 0}), (tree, {tree.maxDepth: 5})], folds)
    assert best == 1 and score > 0.9 and [i for i, _ in results] == [0, 1] and results[0][1] <= 0.01
    (best, _), _ = M.walk_forward_search(regression, [(tree, {tree.maxDepth: 0}), (tree, {tree.maxDepth: 5})], folds, scoring="rmse")
    assert best == 1


def test_extra_trees_search_refits(regression):
    best, results = M.extra_trees_search(regression, M.calendar_folds(regression, 2, 40), n_iter=2, seed=5)
    assert len(results) == 2 and rmse(best.fit(regression).transform(regression)) < 0.5


def test_spot_check_ranks_signal_above_chance(classes):
    models = {"logit": M.CLASSIFIERS["logit"](7), "linear_svc": M.CLASSIFIERS["linear_svc"](7), "knn": M.nearest_votes,
              "chance": lambda tr, te: te.withColumn("rawPrediction", uniform_draw("row_id"))}
    scores = M.spot_check(classes, models, M.column_folds(3))
    assert scores.count() == 12
    mean = {r.model: r.v for r in scores.groupBy("model").agg(F.avg("value").alias("v")).collect()}
    assert min(mean[m] for m in ("logit", "linear_svc", "knn")) > 0.9 and 0.3 < mean["chance"] < 0.7


@pytest.mark.parametrize("only", [0, 1])
def test_spot_check_of_one_class_has_no_area(classes, only):
    one = M.binary_label(classes.where(F.col("label") == only))
    scores = M.spot_check(one, {n: M.CLASSIFIERS[n](7) for n in ("naive_bayes", "decision_tree")}, M.column_folds(3))
    assert [r.value for r in scores.collect()] == [None] * 6


def test_spot_check_scores_the_folds_that_have_both_classes(classes):
    mixed = classes.where("fold != 0 or label = 1")
    got = {r.fold: r.value for r in M.spot_check(mixed, {"tree": M.CLASSIFIERS["decision_tree"](7)}, M.column_folds(3)).collect()}
    assert got[0] is None and min(got[1], got[2]) > 0.8


def _area(rows):
    """Share of the pairs of a row of class 1 and one of class 0 that the score orders (ties count half)."""
    ones, zeros = ([s for s, y in rows if y == c] for c in (1, 0))
    return sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / (len(ones) * len(zeros))


@pytest.mark.parametrize("name", ["decision_tree", "naive_bayes", "random_forest"])
def test_spot_check_scores_class_models_by_probability(spark, name):
    """A large leaf of few ones must not rank above a small one of ones only, nor a far point of class 1 below a near one."""
    rnd = random.Random(5)
    rows = [(i % 2, float(x), int(rnd.random() < (0.4 if x == 0 else 0.9 if x == 6 else 0.05)))
            for i, x in enumerate([0] * 300 + [3] * 100 + [6] * 40)]
    df = spark.createDataFrame(rows, "fold int, x double, y int")
    frame, _ = M.vector_frame(df.withColumn("id", F.monotonically_increasing_id()), ["x"], "y", keep=["fold", "id"])
    got = M.spot_check(frame, {name: M.CLASSIFIERS[name](7)}, M.column_folds(2)).collect()
    for r in got:
        train, test = frame.where(F.col("fold") != r.fold), frame.where(F.col("fold") == r.fold)
        pred = M.fit_predict(train, test, M.CLASSIFIERS[name](7)).select("probability", "label").collect()
        assert r.value == pytest.approx(_area([(float(p.probability[1]), p.label) for p in pred]))


def test_registered_spot_check_compares_the_eight_classifiers(spark, monkeypatch):
    from dealcast.registry.base import QUERIES
    asked = {}

    def noted(frame, models, folds):
        ids = frame.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("row_id").alias("d")).first()
        assert ids.n == ids.d > 0
        asked.update(models=set(models), tested=sorted(frame.where(test).count() for _, test in folds), n=ids.n)
        return spark.createDataFrame([(m, f, 0.5) for m in models for f in range(len(folds))], "model string, fold int, value double")

    monkeypatch.setattr(M, "spot_check", noted)
    got = {r.model: r.n_folds for r in QUERIES["m21_spot_check"](spark, "/root/testdata/sf0.001").collect()}
    eight = {"logit", "knn", "naive_bayes", "linear_svc", "decision_tree", "random_forest", "gradient_boosting", "xgb_like"}
    assert asked["models"] == eight and got == dict.fromkeys(eight, 10)
    assert len(asked["tested"]) == 10 and sum(asked["tested"]) == asked["n"] and asked["tested"][0] > 0


def test_spot_check_classifiers_all_find_the_signal(classes):
    scores = M.spot_check(M.binary_label(classes), M.spot_check_classifiers(7), M.column_folds(3)[:1])
    assert scores.count() == 8 and scores.agg(F.min("value")).first()[0] > 0.85


def test_nearest_votes_are_the_share_of_near_labels(classes):
    train, test = classes.where("fold != 0"), classes.where("fold = 0")
    got = {r.row_id: r.rawPrediction for r in M.nearest_votes(train, test, 3).collect()}
    pts = [(r.features.toArray(), r.row_id, r.label) for r in train.collect()]
    for r in test.limit(25).collect():
        near = sorted((float(((r.features.toArray() - v) ** 2).sum()), i, y) for v, i, y in pts)[:3]
        assert got[r.row_id] == pytest.approx(sum(y for _, _, y in near) / 3)
    assert len(got) == test.count()


def test_forest_and_boosted_searches(classes):
    small = {"numTrees": (3, 6), "maxDepth": [1, 4], "minInstancesPerNode": [1], "featureSubsetStrategy": ["auto"], "bootstrap": [True, False]}
    model, table = M.random_search_classifier(classes, n_iter=2, k=3, space=small)
    assert table.count() == 2 and model.getNumTrees in range(3, 6)
    space = M.boosted_param_space() | {"maxIter": (2, 5), "maxDepth": [2, 3]}
    model, table = M.random_search_classifier(classes, n_iter=2, k=3, space=space, scoring="roc_auc", estimator=GBTClassifier(seed=3))
    assert table.agg(F.min("mean_score")).first()[0] > 0.9 and 2 <= model.getNumTrees < 5


@pytest.mark.parametrize("space", [M.rf_param_space(), M.boosted_param_space(), M.extra_trees_space()])
def test_draws_stay_in_their_ranges(spark, space):
    rows = M.search_draws(spark, space, 200, 9).collect()
    for name, values in space.items():
        seen = {r[name] for r in rows}
        if isinstance(values, list):
            assert seen == set(values)
        else:
            assert min(seen) >= values[0] and max(seen) < max(values[1], 1.0001) and len(seen) > 20
    assert rows == M.search_draws(spark, space, 200, 9).collect()


def test_mutual_information_of_equal_frequency_bins(spark):
    """A skewed feature that tells the label has ln 2, a constant one and an independent one have none."""
    rows = [(10.0 ** (i / 10), i % 2 * 1.0, 3.0, int(i >= 40)) for i in range(80)]
    df = spark.createDataFrame(rows, "skewed double, parity double, flat double, y int")
    got = {r.feature: r.mi for r in X.mutual_info(df, ["skewed", "parity", "flat"], "y", 4).collect()}
    assert got["skewed"] == pytest.approx(math.log(2)) and abs(got["parity"]) < 1e-12 and abs(got["flat"]) < 1e-12


def test_advice_searches_refits_and_forecasts(spark, monkeypatch):
    """The registered advice runs both searches, and what they choose makes the forecasts."""
    from dealcast.operators import models as M
    from dealcast.registry.base import QUERIES
    ran = []
    for name in ("walk_forward_search", "random_search_classifier"):
        def noted(*a, f=getattr(M, name), n=name, **b):
            ran.append(n)
            return f(*a, **b)
        monkeypatch.setattr(M, name, noted)
    rows = QUERIES["m23_r7_model_advice"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(ran) == ["random_search_classifier", "walk_forward_search"]
    assert rows and len({r.brand for r in rows}) == len(rows) and all(r.message for r in rows)
