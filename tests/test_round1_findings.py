"""Edge cases of metrics, dates, matrices, decisions and balancing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dealcast.functions.text import age_to_date
from dealcast.operators import balance as B
from dealcast.operators import metrics as E
from dealcast.operators import models as M
from dealcast.operators.holidays import add_holiday_windows
from dealcast.operators.recommend import recommend
from dealcast.plans.decide import deal_days, training_share
from dealcast.registry.model_queries import _cls_scores

SCORED = "g string, y int, score double, pred int"


@pytest.fixture(scope="module")
def groups(spark):
    rows = [("none", 0, 0.2, 0), ("none", 0, 0.7, 1), ("all", 1, 0.2, 0), ("all", 1, 0.9, 1),
            ("both", 0, 0.1, 0), ("both", 1, 0.8, 1), ("both", 0, 0.6, 1)]
    return spark.createDataFrame(rows, SCORED)


def by_group(df):
    return {r.g: r for r in df.collect()}


def test_metrics_of_one_class_groups(groups):
    """A group of one class has no area, and without positives no precision average; it never fails the others."""
    ap = by_group(E.average_precision(groups, ["g"]))
    assert ap["none"].average_precision is None and ap["all"].average_precision == 1.0 and ap["both"].average_precision == 1.0
    roc = by_group(E.roc_auc_trapezoid(groups, ["g"]))
    assert roc["none"].roc_auc is None and roc["all"].roc_auc is None and roc["both"].roc_auc == 1.0
    s = by_group(E.score_summary(groups, ["g"]))
    assert s["none"].auroc is None and s["none"].average_precision is None and s["none"].accuracy == 0.5
    assert s["all"].auroc is None and s["all"].average_precision == 1.0 and s["both"].auroc == 1.0
    assert by_group(E.auroc(groups, ["g"]))["none"].auroc is None
    assert E.roc_points(groups, ["g"]).where("g = 'none' and tpr is null").count() > 0
    assert E.pr_points(groups, ["g"]).count() > 0 and E.classification_report(groups, ["g"]).count() > 0


@pytest.mark.parametrize("metric", [E.average_precision, E.roc_auc_trapezoid, E.score_summary, E.auroc, E.roc_points, E.pr_points,
                                    E.classification_report, E.classification_metrics])
def test_metrics_of_no_rows(spark, metric):
    assert metric(spark.createDataFrame([], SCORED), ["g"]).count() == 0


def test_margins_are_cut_at_zero(spark):
    """Scores of a model without probabilities are margins around zero."""
    from pyspark.ml.linalg import Vectors
    rows = [("b", float(y), Vectors.dense([-0.3, 0.3] if y else [0.3, -0.3])) for y in (0, 1, 1, 0)]
    pred = spark.createDataFrame(rows, ["brand", "label", "rawPrediction"])
    s = _cls_scores(pred, "margin").first()
    assert s.accuracy == 1.0 and s.f1 == 1.0


def test_age_texts(spark):
    rows = [("3 days ago", 3), ("5 minutes ago", 0), ("3 hours ago", 0), ("2 weeks ago", 14), ("12345678901 days ago", None), ("99999999 weeks ago", None), ("soon", None)]
    df = spark.createDataFrame([(t,) for t, _ in rows], "t string").select("t", age_to_date("t", "2020-06-21").alias("d"))
    got = {r.t: r.d for r in df.collect()}
    assert got == {t: None if n is None else dt.date(2020, 6, 21) - dt.timedelta(n) for t, n in rows}
    month = spark.createDataFrame([("1 month ago",), ("2 years ago",)], "t string").select(age_to_date("t", "2020-03-31").alias("d"))
    assert [r.d for r in month.collect()] == [dt.date(2020, 2, 29), dt.date(2018, 3, 31)]


def test_holidays_of_any_year(spark):
    days = ["1890-07-04", "2150-12-25", "1890-12-31", "2019-12-31", "1860-07-04"]
    df = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], "posted_date date")
    got = {r.posted_date.isoformat(): r for r in add_holiday_windows(df).collect()}
    assert got["1890-07-04"].event_1day == "Independence Day" and got["2150-12-25"].event_1day == "Christmas Day"
    assert got["1890-12-31"].event_7days == "New Year's Day" and got["2019-12-31"].event_1day == "Normal"
    assert got["1860-07-04"].event_1month == "Normal"


def test_matrix_does_not_depend_on_brand_frequencies(spark):
    """The same row has the same vector in a training and a scoring frame with other frequencies."""
    train = spark.createDataFrame([(b, float(k), 0.0) for k, b in enumerate("aabbbbc")], "brand string, x double, y double")
    score = spark.createDataFrame([(b, 1.0, 0.0) for b in "cccbad"], "brand string, x double, y double")
    matrix = M.fit_matrix(train, ["x"], "y")
    tv, names = M.vector_frame(train, ["x"], "y", fitted=matrix)
    sv, again = M.vector_frame(score, ["x"], "y", fitted=matrix)
    brand = lambda df: {r.brand: tuple(r.features.toArray()[1:]) for r in df.collect()}
    t, s = brand(tv), brand(sv)
    assert names == again and names[:4] == ["x", "brand=a", "brand=b", "brand=c"]
    assert all(t[b] == s[b] for b in "abc") and s["d"] not in (t["a"], t["b"], t["c"])
    other, _ = M.vector_frame(spark.createDataFrame([(b, 1.0, 0.0) for b in "cccccba"], "brand string, x double, y double"), ["x"], "y")
    assert brand(other) == t
    assert len(names) == len(tv.first().features)


def test_decisions_and_advice_differ_by_brand(spark):
    """Forecasts that are never zero still mean days without a deal, by each brand's own share."""
    cal = [("rare", d, d % 10 == 0) for d in range(1, 801)] + [("often", d, d % 2 == 0) for d in range(1, 801)] + [("never", d, False) for d in range(1, 801)]
    panel = spark.createDataFrame([(b, d, 800, x) for b, d, x in cal], "brand string, rn int, n int, deal boolean")
    shares = training_share(panel, F.col("deal"))
    fc = [(b, d, 0.1 + 0.001 * ((d * k) % 97), False) for b, k in (("rare", 7), ("often", 11), ("never", 5)) for d in range(100)]
    fc = spark.createDataFrame(fc, "brand string, day_ahead int, pred_discount double, pred_gwp boolean")
    decided = deal_days(fc, shares, "pred_discount", "deal")
    n = {r.brand: r.n for r in decided.groupBy("brand").agg(F.count_if("deal").alias("n")).collect()}
    assert n == {"rare": 10, "often": 50, "never": 0}
    top = decided.groupBy("brand").agg(F.min(F.when(F.col("deal"), F.col("pred_discount"))).alias("lo"), F.max(F.when(~F.col("deal"), F.col("pred_discount"))).alias("hi"))
    assert all(r.lo is None or r.lo >= r.hi for r in top.collect())
    told = {r.brand: r for r in recommend(decided.withColumn("pred_discount", F.when(F.col("deal"), F.col("pred_discount")).otherwise(0.0))).collect()}
    assert not told["never"].has_discount_record and len({r.message for r in told.values()}) == 3


def test_pruned_weight_stays_pruned():
    coef, alpha, lam = M._evidence_1d(200, 50.0, 1e-4, 400.0, ard=True)
    assert coef == 0.0 and lam > 1e4 and alpha > 0


def test_smote_of_a_single_row_class(spark):
    rows = [(k, 0, [float(k), 1.0]) for k in range(6)] + [(100, 1, [3.0, 3.0])]
    with pytest.raises(ValueError, match="single row"):
        B.smote(spark.createDataFrame(rows, "id long, label int, vec array<double>"), "id", "label").count()
