"""Gift-day classification plan: deal-day features, random split, model, tail scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealcast.operators import features as X
from dealcast.operators import models as M
from dealcast.operators.splits import split_random, stratified_folds
from dealcast.plans.decide import deal_days, training_share


def gwp_horizon(panel: DataFrame, estimator=None, seed: int = 42, search: dict | None = None) -> DataFrame:
    """Train a gift-day classifier on deal days (70/30 per brand), then predict
    the tail year's scoring frame (J4: non-deal days carry zero features):
    (brand, day_ahead, pred_gwp).

    The matrix is fitted once, on the training rows; the scoring frame goes through
    the same fitted encoding. The most likely days are gift days, as many as the
    brand's training calendar has. ``search`` (arguments of ``random_search_classifier``)
    runs its search on stratified folds of the training rows and takes the refitted best.
    """
    feats = X.feature_names()
    feat = X.one_hot(X.build_features(panel))
    dd = split_random(X.filter_deal_days(feat), ["posted_date"], 0.7, seed, ["brand"])
    dd = dd.withColumn("y", F.col("gwp").cast("int"))
    matrix = M.fit_matrix(dd.where(F.col("split") == "train"), feats, "y")
    vf, _ = M.vector_frame(dd, feats, "y", keep=["split", "posted_date"], fitted=matrix)
    train = M.binary_label(vf).where(F.col("split") == "train")
    if search is not None:
        args = {"k": 10, "seed": seed, "estimator": estimator} | search
        folds = stratified_folds(train, "label", ["posted_date"], k=args["k"], seed=2, by=["brand"])
        model, _ = M.random_search_classifier(folds, **args)
    else:
        model = (estimator or M.CLASSIFIERS["random_forest"](7)).fit(train)
    score = X.scoring_frame(feat, feats).withColumn("y", F.lit(0))
    sv, _ = M.vector_frame(score, feats, "y", keep=["day_ahead"], fitted=matrix)
    scored = M.positive_score(model.transform(sv), "").select("brand", "day_ahead", "score")
    return deal_days(scored, training_share(panel, F.col("gwp")), "score", "pred_gwp").select("brand", "day_ahead", "pred_gwp")
