"""Forecast plans: naive baselines and a learned discount forecaster over the test year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealcast.operators import features as X
from dealcast.operators import metrics as E
from dealcast.operators import models as M
from dealcast.operators import naive as N
from dealcast.operators.splits import split_tail
from dealcast.plans.decide import deal_days, training_share


def naive_scores(panel: DataFrame) -> DataFrame:
    """Per brand, model and day slot RMSE of the naive walk-forward forecasts."""
    return E.forecast_scores(N.naive_forecasts(panel))


def learned_discount_forecast(panel: DataFrame, estimator=None, candidates: list | None = None, folds: int = 5) -> DataFrame:
    """Fit one pooled regressor on every brand's training days, forecast its test
    year: (brand, day_ahead, pred_discount). Features never include the label.

    ``candidates`` (estimator, parameter map pairs) are compared by walk-forward folds of
    the training calendar and the best one is fitted again on all of them. Days that the
    decision rule doesn't take as discount days are forecast as zero.
    """
    f = split_tail(X.one_hot(X.build_features(panel)))
    f = f.withColumns({"day_ahead": (F.col("rn") - (F.col("n") - 364)).cast("int")})
    feats = X.feature_names()
    matrix = M.fit_matrix(f.where(F.col("split") == "train"), feats, "label")
    vf, _ = M.vector_frame(f, feats, "label", keep=["split", "day_ahead", "posted_date"], fitted=matrix)
    train = vf.where(F.col("split") == "train")
    est, params = estimator or M.REGRESSORS["random_forest"](7), None
    if candidates:
        best, _ = M.walk_forward_search(train, candidates, M.calendar_folds(train, folds))
        est, params = candidates[best[0]]
    pred = est.fit(train, params).transform(vf.where(F.col("split") == "test"))
    pred = pred.select("brand", "day_ahead", F.greatest(F.col("prediction"), F.lit(0.0)).alias("pred_discount"))
    shares = training_share(panel, F.col("discount_off") > 0)
    decided = deal_days(pred, shares, "pred_discount", "_deal")
    return decided.select("brand", "day_ahead", F.when(F.col("_deal"), F.col("pred_discount")).otherwise(F.lit(0.0)).alias("pred_discount"))
