"""Registered queries: one per operator group of the survey, each over the given tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``SQL[name]`` (DuckDB twin,
same column names). Doubles that come out of sums/averages are rounded to 6
places on both sides, as summation order differs between engines.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from dealcast import sqltwins as T
from dealcast.operators import metrics as E
from dealcast.operators import naive as N
from dealcast.operators import rollup as A
from dealcast.plans.clean import build_panel
from dealcast.sources.posts import deals_view

from dealcast.registry.base import D, register


# ---------------------------------------------------------------- shared inputs
def posts(spark, sf):
    return deals_view(spark, sf)


def parsed(spark, sf):
    return A.parse_posts(posts(spark, sf))


def filled(spark, sf):
    return A.fill_calendar(A.daily_rollup(parsed(spark, sf), distinct_counts=False))


def panel(spark, sf):
    return build_panel(posts(spark, sf))


def naive_preds(spark, sf):
    return N.naive_forecasts(panel(spark, sf))


# ---------------------------------------------------------------- sources, parsing
@register("i2_deals_posts", T.with_ctes(T.POSTS) + "SELECT * FROM posts")
def q_deals_posts(spark, sf):
    return posts(spark, sf)


@register("f1_f5_parse_posts", T.with_ctes(T.POSTS, T.PARSED) + "SELECT * FROM parsed")
def q_parse_posts(spark, sf):
    return parsed(spark, sf)


@register("a1_daily_rollup", T.with_ctes(T.POSTS, T.PARSED, T.DAILY_FULL) + "SELECT * FROM daily")
def q_daily_rollup(spark, sf):
    return A.daily_rollup(parsed(spark, sf))


@register("a1_day_lists", T.with_ctes(T.POSTS, T.PARSED) + """
SELECT brand, posted_date, array_to_string(list_sort(list(DISTINCT store)), '|') AS stores,
  array_to_string(list_sort(list(DISTINCT discount)), '|') AS discounts
FROM parsed WHERE posted_date IS NOT NULL GROUP BY brand, posted_date""")
def q_day_lists(spark, sf):
    daily = A.daily_rollup(parsed(spark, sf), keep_lists=True, distinct_counts=False)
    return daily.select("brand", "posted_date", F.array_join("stores", "|").alias("stores"), F.array_join("discounts", "|").alias("discounts"))


@register("j1_fill_calendar", T.BASE_FILLED + "SELECT * FROM filled")
def q_fill_calendar(spark, sf):
    return filled(spark, sf)


@register("j2_panel_with_holidays", T.BASE_PANEL + "SELECT * FROM panel")
def q_panel(spark, sf):
    return panel(spark, sf)


# ---------------------------------------------------------------- naive forecasts and scores
NAIVE_SQL = """,
pos AS (
  SELECT brand, posted_date, rn, n, discount_off AS y,
    CAST(floor((rn - (n - 365) - 1) / 7) AS INT) AS week,
    CAST((((rn - (n - 365) - 1) % 7) + 7) % 7 AS INT) AS slot,
    CASE WHEN rn = n THEN 'last' WHEN rn >= n - 364 THEN 'test' WHEN rn >= 7 THEN 'train' ELSE 'skip' END AS split,
    lag(discount_off, 1) OVER w AS l1, lag(discount_off, 2) OVER w AS l2, lag(discount_off, 3) OVER w AS l3,
    lag(discount_off, 4) OVER w AS l4, lag(discount_off, 5) OVER w AS l5, lag(discount_off, 6) OVER w AS l6,
    lag(discount_off, 7) OVER w AS l7, lag(discount_off, 364) OVER w AS l364
  FROM panel WINDOW w AS (PARTITION BY brand ORDER BY posted_date)),
fc AS (
  SELECT brand, posted_date, week, slot, CAST(rn - (n - 364) AS INT) AS day_ahead, y,
    CASE WHEN rn - (slot + 1) >= 7 THEN [l1, l2, l3, l4, l5, l6, l7][slot + 1] END AS f_daily,
    CASE WHEN rn - 7 >= 7 THEN l7 END AS f_weekly,
    CASE WHEN rn - 364 >= 7 THEN l364 END AS f_week_oya
  FROM pos WHERE split = 'test'),
preds AS (
  SELECT brand, 'daily' AS model, posted_date, day_ahead, week, slot, y, f_daily AS yhat FROM fc
  UNION ALL SELECT brand, 'weekly', posted_date, day_ahead, week, slot, y, f_weekly FROM fc
  UNION ALL SELECT brand, 'week_oya', posted_date, day_ahead, week, slot, y, f_week_oya FROM fc)
"""
NAIVE_BASE = T.BASE_PANEL.rstrip() + NAIVE_SQL


@register("n1_n4_naive_forecasts", NAIVE_BASE + "SELECT * FROM preds")
def q_naive(spark, sf):
    return naive_preds(spark, sf)


FORECAST_SCORES_SQL = NAIVE_BASE + """
SELECT brand, model, CAST(slot AS INT) AS slot, CAST(count(*) AS BIGINT) AS n,
       round(sqrt(sum((yhat - y) * (yhat - y)) / count(*)), 6) AS rmse
FROM preds WHERE yhat IS NOT NULL GROUP BY GROUPING SETS ((brand, model, slot), (brand, model))"""


@register("e3_forecast_scores", FORECAST_SCORES_SQL)
def q_forecast_scores(spark, sf):
    return E.forecast_scores(naive_preds(spark, sf), digits=D)


@register("e1_e2_regression_metrics", NAIVE_BASE + """
SELECT brand, model, count(*) AS n,
  round(avg((yhat - y) * (yhat - y)), 6) AS mse, round(sqrt(avg((yhat - y) * (yhat - y))), 6) AS rmse,
  round(avg(abs(yhat - y)), 6) AS mae, round(abs(avg(yhat - y)), 6) AS abs_bias
FROM preds WHERE yhat IS NOT NULL AND y IS NOT NULL GROUP BY brand, model""")
def q_regression_metrics(spark, sf):
    return E.regression_metrics(naive_preds(spark, sf), ["brand", "model"], digits=D)
