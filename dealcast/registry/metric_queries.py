"""Registered queries: classification metrics and curves, CV summaries, advice."""

from __future__ import annotations

from pyspark.sql import functions as F

from dealcast import sqltwins as T
from dealcast.operators import metrics as E
from dealcast.operators import naive as N
from dealcast.operators import recommend as R
from dealcast.registry.base import D, register
from dealcast.registry.core import NAIVE_BASE, naive_preds, panel

BY = ["brand", "model"]

GWP_SQL = T.BASE_PANEL.rstrip() + """,
gs AS (
  SELECT brand, posted_date, CAST(gwp AS INT) AS y,
    CASE WHEN rn >= 8 THEN avg(CAST(gwp AS DOUBLE)) OVER (PARTITION BY brand ORDER BY posted_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) END AS share,
    CASE WHEN rn >= 365 THEN lag(CAST(gwp AS DOUBLE), 364) OVER (PARTITION BY brand ORDER BY posted_date) END AS oya,
    CASE WHEN rn = n THEN 'last' WHEN rn >= n - 364 THEN 'test' WHEN rn >= 7 THEN 'train' ELSE 'skip' END AS split
  FROM panel),
sc AS (
  SELECT brand, 'gwp_week_share' AS model, posted_date, y, share AS score FROM gs
    WHERE split = 'test' AND share IS NOT NULL AND oya IS NOT NULL
  UNION ALL
  SELECT brand, 'gwp_week_oya', posted_date, y, oya FROM gs
    WHERE split = 'test' AND share IS NOT NULL AND oya IS NOT NULL),
preds AS (SELECT *, CAST(score >= 0.5 AS INT) AS pred FROM sc),
grp AS (
  SELECT brand, model, score, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg
  FROM preds GROUP BY ALL),
cum AS (
  SELECT *, sum(pos) OVER (PARTITION BY brand, model ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_pos,
    sum(neg) OVER (PARTITION BY brand, model ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_neg,
    sum(pos) OVER (PARTITION BY brand, model) AS P, sum(neg) OVER (PARTITION BY brand, model) AS N
  FROM grp)
"""


def gwp_preds(spark, sf):
    return N.naive_gwp_scores(panel(spark, sf))


@register("e5_e6_classification_metrics", GWP_SQL + """
SELECT brand, model, count(*) AS n,
  count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE y = 0 AND pred = 1) AS fp,
  count(*) FILTER (WHERE y = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE y = 0 AND pred = 0) AS tn,
  round((count(*) FILTER (WHERE y = pred)) / count(*), 6) AS accuracy,
  round(CASE WHEN 2 * count(*) FILTER (WHERE y = 1 AND pred = 1) + count(*) FILTER (WHERE y <> pred) > 0
        THEN 2 * count(*) FILTER (WHERE y = 1 AND pred = 1) /
             (2 * count(*) FILTER (WHERE y = 1 AND pred = 1) + count(*) FILTER (WHERE y <> pred)) ELSE 0.0 END, 6) AS f1
FROM preds GROUP BY ALL""")
def q_cls_metrics(spark, sf):
    return E.classification_metrics(gwp_preds(spark, sf), BY, digits=D)


@register("e7_auroc", GWP_SQL + """
SELECT brand, model, round(sum(pos * (N - cum_neg + neg / 2.0)) / (max(P) * max(N)), 6) AS auroc
FROM cum GROUP BY ALL""")
def q_auroc(spark, sf):
    return E.auroc(gwp_preds(spark, sf), BY, digits=D)


@register("e8_average_precision", GWP_SQL + """
SELECT brand, model, round(sum((pos / P) * (cum_pos / (cum_pos + cum_neg))), 6) AS average_precision
FROM cum GROUP BY ALL""")
def q_ap(spark, sf):
    return E.average_precision(gwp_preds(spark, sf), BY, digits=D)


@register("e9_roc_points", GWP_SQL + """,
pts AS (SELECT *, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg, row_number() OVER w AS rk
        FROM cum WINDOW w AS (PARTITION BY brand, model ORDER BY score DESC))
SELECT brand, model, score AS threshold, round(cum_neg / N, 6) AS fpr, round(cum_pos / P, 6) AS tpr FROM pts
WHERE rk = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
UNION ALL SELECT brand, model, score + 1, 0.0, 0.0 FROM pts WHERE rk = 1""")
def q_roc(spark, sf):
    return E.roc_points(gwp_preds(spark, sf), BY, digits=D)


@register("e10_pr_points", GWP_SQL + """,
fr AS (SELECT brand, model, max(score) AS fs FROM cum WHERE cum_pos = P GROUP BY ALL)
SELECT c.brand, c.model, c.score AS threshold, round(cum_pos / (cum_pos + cum_neg), 6) AS precision,
       round(cum_pos / P, 6) AS recall
FROM cum c LEFT JOIN fr ON c.brand = fr.brand AND c.model = fr.model WHERE fr.fs IS NULL OR c.score >= fr.fs
UNION ALL SELECT brand, model, CAST(NULL AS DOUBLE), 1.0, 0.0 FROM (SELECT DISTINCT brand, model FROM cum)""")
def q_pr(spark, sf):
    return E.pr_points(gwp_preds(spark, sf), BY, digits=D)


@register("e11_trapezoid_auc", GWP_SQL + """,
pts AS (SELECT brand, model, cum_neg / N AS fpr, cum_pos / P AS tpr,
          coalesce(lag(cum_neg / N) OVER (PARTITION BY brand, model ORDER BY score DESC), 0.0) AS pf,
          coalesce(lag(cum_pos / P) OVER (PARTITION BY brand, model ORDER BY score DESC), 0.0) AS pt FROM cum)
SELECT brand, model, round(sum((fpr - pf) * (tpr + pt) / 2.0), 6) AS roc_auc FROM pts GROUP BY ALL""")
def q_trapezoid(spark, sf):
    return E.roc_auc_trapezoid(gwp_preds(spark, sf), BY, digits=D)


@register("e12_classification_report", GWP_SQL + """,
conf AS (SELECT brand, model, y, pred, count(*) AS c FROM preds GROUP BY ALL),
cls AS (SELECT DISTINCT brand, model, y AS cls FROM conf UNION SELECT DISTINCT brand, model, pred FROM conf),
per AS (
  SELECT k.brand, k.model, CAST(k.cls AS VARCHAR) AS label,
    coalesce(sum(c) FILTER (WHERE y = k.cls AND pred = k.cls), 0) AS tp,
    coalesce(sum(c) FILTER (WHERE pred = k.cls), 0) AS pp,
    coalesce(sum(c) FILTER (WHERE y = k.cls), 0) AS support
  FROM cls k LEFT JOIN conf f ON k.brand = f.brand AND k.model = f.model GROUP BY ALL),
pr AS (SELECT brand, model, label, CASE WHEN pp > 0 THEN tp / pp ELSE 0.0 END AS precision,
         CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, CAST(support AS BIGINT) AS support FROM per),
pf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM pr),
allr AS (
  SELECT * FROM pf
  UNION ALL SELECT brand, model, 'macro avg', avg(precision), avg(recall), CAST(sum(support) AS BIGINT), avg(f1) FROM pf GROUP BY ALL
  UNION ALL SELECT brand, model, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    CAST(sum(support) AS BIGINT), sum(f1 * support) / sum(support) FROM pf GROUP BY ALL
  UNION ALL SELECT brand, model, 'accuracy', NULL, NULL, CAST(sum(c) AS BIGINT),
    sum(c) FILTER (WHERE y = pred) / sum(c) FROM conf GROUP BY ALL)
SELECT brand, model, label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM allr""")
def q_report(spark, sf):
    return E.classification_report(gwp_preds(spark, sf), BY, digits=D)


@register("e13_compare_models", GWP_SQL + """
SELECT brand, model, CAST(sum(pos + neg) AS BIGINT) AS n,
  round(sum(pos * (N - cum_neg + neg / 2.0)) / (max(P) * max(N)), 6) AS auroc,
  round(sum((pos / P) * (cum_pos / (cum_pos + cum_neg))), 6) AS average_precision,
  round((coalesce(sum(pos) FILTER (WHERE score >= 0.5), 0) + max(N) - coalesce(sum(neg) FILTER (WHERE score >= 0.5), 0)) / sum(pos + neg), 6) AS accuracy,
  round(CASE WHEN 2 * coalesce(sum(pos) FILTER (WHERE score >= 0.5), 0) + coalesce(sum(neg) FILTER (WHERE score >= 0.5), 0)
                  + (max(P) - coalesce(sum(pos) FILTER (WHERE score >= 0.5), 0)) > 0
        THEN 2 * coalesce(sum(pos) FILTER (WHERE score >= 0.5), 0) /
             (2 * coalesce(sum(pos) FILTER (WHERE score >= 0.5), 0) + coalesce(sum(neg) FILTER (WHERE score >= 0.5), 0)
              + (max(P) - coalesce(sum(pos) FILTER (WHERE score >= 0.5), 0))) ELSE 0.0 END, 6) AS f1
FROM cum GROUP BY ALL""")
def q_compare(spark, sf):
    return E.score_summary(gwp_preds(spark, sf), BY, digits=D)


# ---------------------------------------------------------------- regression summaries
@register("a9_cv_summary", NAIVE_BASE + """,
wk AS (SELECT brand, model, week, sqrt(avg((yhat - y) * (yhat - y))) AS value FROM preds WHERE yhat IS NOT NULL GROUP BY ALL)
SELECT brand, model, count(value) AS n_folds, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std,
  round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS median,
  round(quantile_cont(value, 0.75), 6) AS q3, round(max(value), 6) AS max
FROM wk GROUP BY ALL""")
def q_cv_summary(spark, sf):
    p = naive_preds(spark, sf).where(F.col("yhat").isNotNull())
    e = F.col("yhat") - F.col("y")
    wk = p.groupBy("brand", "model", "week").agg(F.sqrt(F.avg(e * e)).alias("value"))
    return E.cv_summary(wk, BY, digits=D)


@register("e4_format_scores", NAIVE_BASE + """,
sl AS (SELECT brand, model, slot, sqrt(sum((yhat - y) * (yhat - y)) / count(*)) AS rmse FROM preds WHERE yhat IS NOT NULL GROUP BY ALL),
ov AS (SELECT brand, model, sqrt(sum((yhat - y) * (yhat - y)) / count(*)) AS overall FROM preds WHERE yhat IS NOT NULL GROUP BY ALL)
SELECT sl.brand, sl.model, printf('%s: [%.3f] %s', sl.model, max(ov.overall), string_agg(printf('%.1f', sl.rmse), ', ' ORDER BY sl.slot)) AS line
FROM sl JOIN ov ON sl.brand = ov.brand AND sl.model = ov.model GROUP BY sl.brand, sl.model""")
def q_format(spark, sf):
    return E.format_scores(E.forecast_scores(naive_preds(spark, sf)))


# ---------------------------------------------------------------- advice
ADVICE_SQL = T.BASE_PANEL.rstrip() + """,
ai AS (
  SELECT brand, CAST(rn - (n - 364) AS INT) AS day_ahead,
    CASE WHEN rn - 364 >= 7 THEN lag(discount_off, 364) OVER w END AS pred_discount,
    CASE WHEN rn - 364 >= 7 THEN lag(gwp, 364) OVER w END AS pred_gwp,
    CASE WHEN rn = n THEN 'last' WHEN rn >= n - 364 THEN 'test' WHEN rn >= 7 THEN 'train' ELSE 'skip' END AS split
  FROM panel WINDOW w AS (PARTITION BY brand ORDER BY posted_date)),
adv_in AS (SELECT brand, day_ahead, pred_discount, pred_gwp FROM ai WHERE split = 'test' AND pred_discount IS NOT NULL)
"""


def _advice_sql() -> str:
    return ADVICE_SQL.rstrip() + f""",
src AS (SELECT * FROM adv_in),
f AS (
  SELECT brand, max(pred_discount) AS best_discount,
    min(CASE WHEN pred_discount > 0 THEN day_ahead END) AS next_discount_day,
    arg_min(pred_discount, day_ahead) FILTER (WHERE pred_discount > 0) AS next_discount,
    min(CASE WHEN pred_gwp THEN day_ahead END) AS next_gwp_day,
    coalesce(bool_or(pred_discount > 0) FILTER (WHERE day_ahead = 0), false) AS discount_today,
    coalesce(bool_or(pred_gwp) FILTER (WHERE day_ahead = 0), false) AS gwp_today,
    coalesce(bool_or(pred_discount <> 0), false) AS has_discount_record
  FROM src GROUP BY brand),
b AS (SELECT s.brand, min(s.day_ahead) AS best_day FROM src s JOIN f ON s.brand = f.brand AND s.pred_discount = f.best_discount GROUP BY s.brand)
SELECT f.brand, has_discount_record, discount_today, gwp_today, best_day,
  round(best_discount * 100.0, 6) AS best_discount_pct, next_discount_day,
  round(next_discount * 100.0, 6) AS next_discount_pct, next_gwp_day,
  CASE WHEN has_discount_record THEN concat_ws(' ',
      CASE WHEN NOT discount_today AND NOT gwp_today THEN {T._q(R.MSG_NONE_TODAY)}
           WHEN NOT discount_today AND gwp_today THEN {T._q(R.MSG_GWP_TODAY)}
           WHEN discount_today AND gwp_today THEN {T._q(R.MSG_BOTH_TODAY)}
           ELSE {T._q(R.MSG_PCT_TODAY)} END,
      printf({T._q(R.MSG_BEST_DAY)}, CAST(best_day AS VARCHAR)),
      printf({T._q(R.MSG_BEST_PCT)}, best_discount * 100.0),
      printf({T._q(R.MSG_NEXT)}, CAST(next_discount_day AS VARCHAR), next_discount * 100.0))
  ELSE concat_ws(' ', {T._q(R.MSG_NO_RECORD)}, {T._q(R.MSG_GWP_ONLY)},
      CASE WHEN next_gwp_day IS NOT NULL THEN printf({T._q(R.MSG_NEXT_GWP)}, CAST(next_gwp_day AS VARCHAR)) END) END AS message
FROM f JOIN b ON f.brand = b.brand"""


def advice_in(spark, sf):
    return N.advice_input(panel(spark, sf))


@register("r1_r7_recommend", _advice_sql())
def q_recommend(spark, sf):
    return R.recommend(advice_in(spark, sf))


@register("r5_horizon_recommend", ADVICE_SQL.rstrip() + """
SELECT brand, day_ahead, pred_discount, pred_gwp FROM adv_in WHERE day_ahead < 29""")
def q_horizon(spark, sf):
    return R.horizon(advice_in(spark, sf), 30).select("brand", "day_ahead", "pred_discount", "pred_gwp")
