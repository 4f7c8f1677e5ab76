"""Evaluation metrics as aggregations.

Regression metrics are single-pass aggregations with map-side partial
aggregation. Ranking metrics (AUROC, AP, curves) are exact: scores are first
collapsed to one row per distinct (group, score), then a distributed prefix sum
(``operators.ordered``) supplies the running counts, so no task ever has to
hold a whole group's scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealcast.operators.ordered import running_sums


def _r(c, nd: int | None):
    return F.round(c, nd) if nd is not None else c


def regression_metrics(preds: DataFrame, by: list[str], y: str = "y", yhat: str = "yhat",
                       digits: int | None = None) -> DataFrame:
    """n, MSE, RMSE, MAE and absolute bias per group.

    ``abs_bias`` = |mean(yhat - y)| is the quantity the reference printed as
    "rmse" (Q11); both are given under their proper names. Rows with a null
    forecast are ignored.
    """
    e = F.col(yhat) - F.col(y)
    d = preds.where(F.col(yhat).isNotNull() & F.col(y).isNotNull())
    return d.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        _r(F.avg(e * e), digits).alias("mse"),
        _r(F.sqrt(F.avg(e * e)), digits).alias("rmse"),
        _r(F.avg(F.abs(e)), digits).alias("mae"),
        _r(F.abs(F.avg(e)), digits).alias("abs_bias"),
    )


def forecast_scores(preds: DataFrame, by: list[str] | None = None, digits: int | None = None) -> DataFrame:
    """RMSE per day slot (0..6) and overall per model.

    One GROUPING SETS aggregation ((by, slot), (by)): a single scan, rows
    duplicated by Expand before the map-side partial aggregation. The overall
    row has slot = null.
    """
    by = by or ["brand", "model"]
    e = F.col("yhat") - F.col("y")
    g = (preds.where(F.col("yhat").isNotNull())
         .groupingSets([[*by, "slot"], list(by)], *by, "slot")
         .agg(F.sum(e * e).alias("sse"), F.count(F.lit(1)).alias("n")))
    return g.select(*by, F.col("slot").cast("int").alias("slot"), F.col("n").cast("bigint").alias("n"),
                    _r(F.sqrt(F.col("sse") / F.col("n")), digits).alias("rmse"))


def format_scores(scores: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One summary line per model: ``name: [overall] s0, s1, ...``.

    Runs on the score table (8 rows per model); numbers use Python's rounding.
    """
    from dealcast.functions.format import fixed
    by = by or ["brand", "model"]
    sl = scores.where(F.col("slot").isNotNull()).select(*by, "slot", fixed("rmse", 1).alias("txt"))
    per = sl.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("slot", "txt"))).alias("s"))
    tot = scores.where(F.col("slot").isNull()).select(*by, fixed("rmse", 3).alias("overall"))
    j = per.join(tot, by)
    slots = F.array_join(F.transform("s", lambda x: x["txt"]), ", ")
    return j.select(*by, F.concat(F.col(by[-1]), F.lit(": ["), F.col("overall"), F.lit("] "), slots).alias("line"))


def classification_metrics(preds: DataFrame, by: list[str], y: str = "y", pred: str = "pred",
                           digits: int | None = None) -> DataFrame:
    """Accuracy and F1 of the positive class (E5, E6) from confusion counts."""
    yy, pp = F.col(y).cast("int"), F.col(pred).cast("int")
    c = preds.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((yy == 1) & (pp == 1)).alias("tp"),
        F.count_if((yy == 0) & (pp == 1)).alias("fp"),
        F.count_if((yy == 1) & (pp == 0)).alias("fn"),
        F.count_if((yy == 0) & (pp == 0)).alias("tn"),
    )
    f1 = F.when(2 * F.col("tp") + F.col("fp") + F.col("fn") > 0,
                2 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn"))).otherwise(F.lit(0.0))
    return c.select(*by, "n", "tp", "fp", "fn", "tn",
                    _r((F.col("tp") + F.col("tn")) / F.col("n"), digits).alias("accuracy"),
                    _r(f1, digits).alias("f1"))


def _score_groups(preds: DataFrame, by: list[str], y: str, score: str) -> DataFrame:
    """One row per distinct (group, score) with its positive/negative counts."""
    yy = F.col(y).cast("int")
    return preds.groupBy(*by, F.col(score).cast("double").alias("score")).agg(
        F.count_if(yy == 1).alias("pos"), F.count_if(yy != 1).alias("neg"))


def _curve_base(preds: DataFrame, by: list[str], y: str, score: str) -> DataFrame:
    g = _score_groups(preds, by, y, score)
    # running counts from the highest score down: tps/fps at threshold = score
    return running_sums(g, by, "score", ["pos", "neg"], descending=True, out_prefix="cum_")


def _with_totals(base: DataFrame) -> DataFrame:
    return base.withColumnsRenamed({"tot_pos": "pos_total", "tot_neg": "neg_total"})


def roc_points(preds: DataFrame, by: list[str], y: str = "y", score: str = "score",
               digits: int | None = None, drop_intermediate: bool = True) -> DataFrame:
    """ROC curve points (E9): (threshold, fpr, tpr), one candidate point per
    distinct score (``score >= threshold`` is positive), plus the (0, 0) start
    whose threshold is the top score + 1.

    ``drop_intermediate`` keeps, besides the first and last point, only points
    where the next step's (positives, negatives) increments differ from this
    point's -- the standard thinning of suboptimal points; areas are unchanged.
    """
    g = _score_groups(preds, by, y, score)
    base = running_sums(g, by, "score", ["pos", "neg"], descending=True, out_prefix="cum_",
                        next_cols=["pos", "neg"])
    j = _with_totals(base)
    first = F.col("cum_pos") + F.col("cum_neg") == F.col("pos") + F.col("neg")
    last = F.col("next_pos").isNull()
    if drop_intermediate:
        changes = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
        j = j.where(first | last | changes)
    pts = j.select(*by, F.col("score").alias("threshold"),
                   F.try_divide(F.col("cum_neg"), F.col("neg_total")).alias("fpr"),
                   F.try_divide(F.col("cum_pos"), F.col("pos_total")).alias("tpr"))
    start = j.where(first).select(*by, (F.col("score") + 1).alias("threshold"), F.lit(0.0).alias("fpr"),
                                  F.lit(0.0).alias("tpr"))
    out = pts.unionByName(start)
    return out.select(*by, "threshold", _r(F.col("fpr"), digits).alias("fpr"), _r(F.col("tpr"), digits).alias("tpr"))


def pr_points(preds: DataFrame, by: list[str], y: str = "y", score: str = "score",
              digits: int | None = None) -> DataFrame:
    """Precision-recall points (E10): one per distinct score threshold, from the
    top score down to the first threshold reaching full recall, plus the
    (precision 1, recall 0) end point without a threshold."""
    j = _with_totals(_curve_base(preds, by, y, score))
    full = j.where(F.col("cum_pos") == F.col("pos_total")).groupBy(*by).agg(F.max("score").alias("_full"))
    k = j.join(full, by, "left").where(F.col("_full").isNull() | (F.col("score") >= F.col("_full")))
    pts = k.select(*by, F.col("score").alias("threshold"),
                   (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
                   F.try_divide(F.col("cum_pos"), F.col("pos_total")).alias("recall"))
    end = j.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).select(
        *by, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    out = pts.unionByName(end)
    return out.select(*by, "threshold", _r(F.col("precision"), digits).alias("precision"),
                      _r(F.col("recall"), digits).alias("recall"))


def auroc(preds: DataFrame, by: list[str], y: str = "y", score: str = "score",
          digits: int | None = None) -> DataFrame:
    """Exact area under ROC with ties counted half (E7) == trapezoid area over all thresholds.

    Sum over distinct scores of pos_s * (negatives below s + neg_s / 2), over P * N.
    """
    j = _with_totals(_curve_base(preds, by, y, score))
    term = F.col("pos") * (F.col("neg_total") - F.col("cum_neg") + F.col("neg") / 2.0)
    agg = j.groupBy(*by).agg(F.sum(term).alias("u"), F.first("pos_total").alias("pos_total"), F.first("neg_total").alias("neg_total"))
    return agg.select(*by, _r(F.try_divide(F.col("u"), F.col("pos_total") * F.col("neg_total")), digits).alias("auroc"))


def average_precision(preds: DataFrame, by: list[str], y: str = "y", score: str = "score",
                      digits: int | None = None) -> DataFrame:
    """Average precision as a step sum (E8): sum of (recall step) x precision at each threshold."""
    j = _with_totals(_curve_base(preds, by, y, score))
    # a group without positives has no recall: null, not an error
    term = F.try_divide(F.col("pos"), F.col("pos_total")) * (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")))
    return j.groupBy(*by).agg(_r(F.sum(term), digits).alias("average_precision"))


def trapezoid_auc_from_steps(points: DataFrame, by: list[str], x: str, y: str, dx: str, dy: str,
                             digits: int | None = None) -> DataFrame:
    """Trapezoid area of a monotone curve whose rows carry their own steps (E11):
    area = sum dx * (2y - dy) / 2 -- no lag window, so it runs fully partial-aggregated."""
    term = F.col(dx) * (2 * F.col(y) - F.col(dy)) / 2.0
    return points.groupBy(*by).agg(_r(F.sum(term), digits).alias("area"))


def roc_auc_trapezoid(preds: DataFrame, by: list[str], y: str = "y", score: str = "score",
                      digits: int | None = None) -> DataFrame:
    """E11 applied to the ROC curve (E9) from (0, 0): equals ``auroc``."""
    j = _with_totals(_curve_base(preds, by, y, score)).select(
        *by, F.try_divide("cum_neg", "neg_total").alias("fpr"), F.try_divide("cum_pos", "pos_total").alias("tpr"),
        F.try_divide("neg", "neg_total").alias("dfpr"), F.try_divide("pos", "pos_total").alias("dtpr"))
    return trapezoid_auc_from_steps(j, by, "fpr", "tpr", "dfpr", "dtpr", digits).withColumnRenamed("area", "roc_auc")


def classification_report(preds: DataFrame, by: list[str], y: str = "y", pred: str = "pred",
                          digits: int | None = None) -> DataFrame:
    """Per-class precision/recall/F1/support plus accuracy, macro and weighted rows.

    Confusion counts come from one ``groupBy(group, y, pred)``; everything else
    works on that (at most 4 rows per group for a binary label).
    """
    yy, pp = F.col(y).cast("int"), F.col(pred).cast("int")
    conf = preds.groupBy(*by, yy.alias("yv"), pp.alias("pv")).agg(F.count(F.lit(1)).alias("c"))
    classes = conf.select(*by, F.col("yv").alias("cls")).union(conf.select(*by, F.col("pv").alias("cls"))).distinct()
    j = classes.join(conf, by, "left")
    per = j.groupBy(*by, "cls").agg(
        F.sum(F.when((F.col("yv") == F.col("cls")) & (F.col("pv") == F.col("cls")), F.col("c")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("pv") == F.col("cls"), F.col("c")).otherwise(0)).alias("pred_pos"),
        F.sum(F.when(F.col("yv") == F.col("cls"), F.col("c")).otherwise(0)).alias("support"),
    )
    prec = F.when(F.col("pred_pos") > 0, F.col("tp") / F.col("pred_pos")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    per = per.select(*by, F.col("cls").cast("string").alias("label"), prec.alias("precision"),
                     rec.alias("recall"), F.col("support").cast("bigint").alias("support"))
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0))
    per = per.withColumn("f1", f1)
    macro = per.groupBy(*by).agg(F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
                                 F.sum("support").cast("bigint").alias("support"), F.avg("f1").alias("f1")
                                 ).withColumn("label", F.lit("macro avg"))
    wsum = lambda c: F.sum(F.col(c) * F.col("support")) / F.sum("support")
    weighted = per.groupBy(*by).agg(wsum("precision").alias("precision"), wsum("recall").alias("recall"),
                                    F.sum("support").cast("bigint").alias("support"), wsum("f1").alias("f1")
                                    ).withColumn("label", F.lit("weighted avg"))
    acc = (conf.groupBy(*by).agg(
        (F.sum(F.when(F.col("yv") == F.col("pv"), F.col("c")).otherwise(0)) / F.sum("c")).alias("f1"),
        F.sum("c").alias("support"))
        .select(*by, F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                F.lit(None).cast("double").alias("recall"), F.col("support").cast("bigint").alias("support"), "f1"))
    out = per.unionByName(macro).unionByName(weighted).unionByName(acc)
    return out.select(*by, "label", *[_r(F.col(c), digits).alias(c) for c in ("precision", "recall", "f1")], "support")


def cv_summary(scores: DataFrame, by: list[str] | None = None, value: str = "value",
               digits: int | None = None) -> DataFrame:
    """Fold score summary per model: mean, population std, quartiles."""
    by = by or ["model"]
    v = F.col(value)
    return scores.groupBy(*by).agg(
        F.count(v).alias("n_folds"),
        _r(F.avg(v), digits).alias("mean"),
        _r(F.stddev_pop(v), digits).alias("std"),
        _r(F.min(v), digits).alias("min"),
        _r(F.percentile(v, 0.25), digits).alias("q1"),
        _r(F.percentile(v, 0.5), digits).alias("median"),
        _r(F.percentile(v, 0.75), digits).alias("q3"),
        _r(F.max(v), digits).alias("max"),
    )


def compare_models(scores: DataFrame, by: list[str] | None = None, metric_col: str = "metric",
                   value: str = "value", metrics: list[str] | None = None) -> DataFrame:
    """Model comparison table (E13): long (model, metric, value) -> one column per metric."""
    by = by or ["model"]
    g = scores.groupBy(*by)
    return (g.pivot(metric_col, metrics) if metrics else g.pivot(metric_col)).agg(F.first(value))


def score_summary(preds: DataFrame, by: list[str], y: str = "y", score: str = "score",
                  threshold: float = 0.5, digits: int | None = None) -> DataFrame:
    """AUROC, average precision, accuracy and F1 at ``threshold`` in one pass.

    Everything derives from the distinct-score table with running counts, so
    one distributed prefix sum serves all four metrics.
    """
    j = _with_totals(_curve_base(preds, by, y, score))
    above = F.col("score") >= threshold
    g = j.groupBy(*by).agg(
        F.sum(F.col("pos") + F.col("neg")).alias("n_scored"),
        F.sum(F.col("pos") * (F.col("neg_total") - F.col("cum_neg") + F.col("neg") / 2.0)).alias("u"),
        F.sum(F.try_divide(F.col("pos"), F.col("pos_total")) * (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")))).alias("ap"),
        F.sum(F.when(above, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(above, F.col("neg")).otherwise(0)).alias("fp"),
        F.first("pos_total").alias("pos_total"), F.first("neg_total").alias("neg_total"))
    acc = (F.col("tp") + F.col("neg_total") - F.col("fp")) / F.col("n_scored")
    f1d = 2 * F.col("tp") + F.col("fp") + (F.col("pos_total") - F.col("tp"))
    f1 = F.when(f1d > 0, 2 * F.col("tp") / f1d).otherwise(F.lit(0.0))
    return g.select(*by, F.col("n_scored").cast("bigint").alias("n"),
                    _r(F.try_divide(F.col("u"), F.col("pos_total") * F.col("neg_total")), digits).alias("auroc"),
                    _r(F.col("ap"), digits).alias("average_precision"),
                    _r(acc, digits).alias("accuracy"), _r(f1, digits).alias("f1"))
