"""Registered queries: robust line, linear-model table, linear models on many features."""

from __future__ import annotations

from pyspark.sql import functions as F

from dealcast.operators import linear as L
from dealcast.operators import models as M
from dealcast.operators.robust import theil_sen
from dealcast.registry.base import D, register
from dealcast.registry.model_queries import EVIDENCE_SQL, TREND_SQL, _trend_data
from dealcast.registry.panel_queries import FEAT_BASE, features


THEIL_SQL = """
sl AS (SELECT a.brand, a.days, median((b.y - a.y) / (b.x - a.x)) AS slope FROM series a JOIN series b ON a.brand = b.brand AND a.days = b.days AND a.x < b.x GROUP BY ALL),
th AS (SELECT s.brand, s.days, sl.slope, median(s.y - sl.slope * s.x) AS intercept FROM series s JOIN sl ON s.brand = sl.brand AND s.days = sl.days GROUP BY ALL)"""


@register("m5_theil_sen", TREND_SQL.rstrip() + """,
series AS (SELECT brand, 'all' AS days, CAST(rn AS DOUBLE) AS x, discount_off AS y FROM tr
  UNION ALL SELECT brand, 'deal', rn, discount_off FROM tr WHERE discount_off <> 0),""" + THEIL_SQL + """
SELECT brand, days, round(slope, 10) + 0.0 AS slope, round(intercept, 8) + 0.0 AS intercept FROM th""")
def q_theil_sen(spark, sf):
    """Robust trend of every brand's discount, over all training days and over those with a discount."""
    tr, _ = _trend_data(spark, sf)
    series = tr.withColumn("days", F.explode(F.when(F.col("discount_off") != 0, F.array(F.lit("all"), F.lit("deal"))).otherwise(F.array(F.lit("all")))))
    got = theil_sen(series, "rn", "discount_off", ["brand", "days"]).where("slope is not null")
    return got.select("brand", "days", (F.round("slope", 10) + 0.0).alias("slope"), (F.round("intercept", 8) + 0.0).alias("intercept"))


def _table_sql() -> str:
    evidence = EVIDENCE_SQL[:EVIDENCE_SQL.index("sc AS (SELECT te.brand, cf.model")].rstrip().rstrip(",")
    line = lambda name, slope: f"SELECT brand, '{name}' AS model, {slope} AS slope, avg(discount_off) - ({slope}) * avg(CAST(rn AS DOUBLE)) AS intercept FROM tr GROUP BY brand"
    cov, var = "covar_pop(CAST(rn AS DOUBLE), discount_off)", "var_pop(CAST(rn AS DOUBLE))"
    return evidence + """,
series AS (SELECT brand, 'all' AS days, CAST(rn AS DOUBLE) AS x, discount_off AS y FROM tr),""" + THEIL_SQL + f""",
every AS (
  SELECT brand, model, slope, intercept FROM cf UNION ALL SELECT brand, 'theil_sen', slope, intercept FROM th
  UNION ALL {line('linear', f'{cov} / {var}')}
  UNION ALL {line('lasso_lars', f'CASE WHEN abs({cov}) > 1.0 THEN sign({cov}) * (abs({cov}) - 1.0) / {var} ELSE 0.0 END')}),
days AS (SELECT brand, rn, discount_off, 'train' AS split FROM tr UNION ALL SELECT brand, rn, discount_off, 'test' FROM te)
SELECT e.brand, e.model, round(100 * avg((e.intercept + e.slope * d.rn - d.discount_off) ^ 2) FILTER (WHERE d.split = 'train'), 6) AS train_mse100,
  round(100 * avg((e.intercept + e.slope * d.rn - d.discount_off) ^ 2) FILTER (WHERE d.split = 'test'), 6) AS validation_mse100
FROM every e JOIN days d ON e.brand = d.brand GROUP BY ALL"""


@register("m1_m5_linear_table", _table_sql())
def q_linear_table(spark, sf):
    """The linear models' table: mean squared error (times 100) on training and validation days per brand."""
    tr, te = _trend_data(spark, sf)
    x = ("rn", "discount_off", ["brand"])
    fits = {"linear": M.ols_trend(tr, *x), "lasso_lars": M.lasso_trend(tr, *x, alpha=1.0), "bayesian_ridge": M.bayes_trend(tr, *x),
            "ard": M.bayes_trend(tr, *x, ard=True), "theil_sen": theil_sen(tr, *x)}
    lines = None
    for name, fit in fits.items():
        one = fit.select("brand", F.lit(name).alias("model"), "slope", "intercept")
        lines = one if lines is None else lines.unionByName(one)
    days = tr.unionByName(te)
    error = F.pow(F.col("intercept") + F.col("slope") * F.col("rn") - F.col("discount_off"), 2)
    of = lambda s: F.round(100 * F.avg(F.when(F.col("split") == s, error)), D)
    return days.join(lines, "brand").groupBy("brand", "model").agg(of("train").alias("train_mse100"), of("test").alias("validation_mse100"))


LINEAR_FEATS = ["t_1", "t_7", "t_30", "mean_14", "month"]


def _products_sql(scaled: bool) -> str:
    """n, g (list of lists), b, yy, mx, my and the features' sizes of each brand's training rows."""
    f, d = LINEAR_FEATS, len(LINEAR_FEATS)
    size = lambda c: f"CASE WHEN var_pop({c}) > 0 THEN sqrt(var_pop({c})) ELSE 1 END" if scaled else "CAST(1 AS DOUBLE)"
    g = ", ".join("[" + ", ".join(f"count(*) * covar_pop({x}, {z}) / ({size(x)} * {size(z)})" for z in f) + "]" for x in f)
    return FEAT_BASE.rstrip() + f""",
rows AS (SELECT brand, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in f)}, CAST(label AS DOUBLE) AS y FROM feat WHERE rn >= 7 AND rn < n - 364),
mo AS (SELECT brand, CAST(count(*) AS DOUBLE) AS n, [{g}] AS g, [{", ".join(f"count(*) * covar_pop({x}, y) / ({size(x)})" for x in f)}] AS b,
  count(*) * var_pop(y) AS yy, [{", ".join(f"avg({x})" for x in f)}] AS mx, avg(y) AS my, [{", ".join(size(x) for x in f)}] AS size FROM rows GROUP BY brand),
names AS (SELECT unnest(range(1, {d + 2})) AS j, unnest([{", ".join(f"'{x}'" for x in f)}, NULL]) AS feature)"""


def _coef_out(steps: str) -> str:
    d = len(LINEAR_FEATS)
    return steps + f""",
ended AS (SELECT brand, model, max_by(coef, i) AS coef FROM steps GROUP BY brand, model),
own AS (SELECT e.brand, e.model, mx, my, list_transform(range(1, {d + 1}), lambda j: e.coef[j] / mo.size[j]) AS w FROM ended e JOIN mo ON e.brand = mo.brand)
SELECT brand, model, feature, round(CASE WHEN j <= {d} THEN w[j] ELSE my - list_sum(list_transform(range(1, {d + 1}), lambda k: w[k] * mx[k])) END, 6) + 0.0 AS coef FROM own, names"""


def _bayes_sql() -> str:
    d = len(LINEAR_FEATS)
    r = f"range(1, {d + 1})"
    work = f"""SELECT brand, model, n, g, b, yy, i, coef AS before, lam, alpha, kept,
      list_transform({r}, lambda p: list_concat(list_transform({r}, lambda q: CASE WHEN kept[p] AND kept[q] THEN alpha * g[p][q] + CASE WHEN p = q THEN lam[p] ELSE 0 END WHEN p = q THEN 1 ELSE 0 END),
        list_transform({r}, lambda q: CASE WHEN p = q THEN CAST(1 AS DOUBLE) ELSE 0 END))) AS a
    FROM (SELECT *, list_transform(lam, lambda l: model = 'bayesian_ridge' OR l <= 1e4) AS kept FROM steps WHERE NOT done AND i < 300)"""
    for p in range(1, d + 1):  # Gauss-Jordan
        work = f"""SELECT * EXCLUDE (a), list_transform({r}, lambda p: list_transform(range(1, {2 * d + 1}), lambda q:
      CASE WHEN p = {p} THEN a[{p}][q] / a[{p}][{p}] ELSE a[p][q] - a[p][{p}] * a[{p}][q] / a[{p}][{p}] END)) AS a FROM ({work})"""
    dot = lambda x, y: f"list_sum(list_transform({r}, lambda k: {x}[k] * {y}[k]))"
    work = f"""SELECT *, list_transform({r}, lambda p: CASE WHEN kept[p] THEN alpha * list_sum(list_transform({r}, lambda q: CASE WHEN kept[q] THEN a[p][q + {d}] * b[q] ELSE 0 END)) ELSE 0 END) AS c,
      list_transform({r}, lambda p: CASE WHEN kept[p] THEN 1 - lam[p] * a[p][p + {d}] ELSE 0 END) AS gam FROM ({work})"""
    work = f"""SELECT *, yy - 2 * {dot('c', 'b')} + list_sum(list_transform({r}, lambda p: c[p] * list_sum(list_transform({r}, lambda q: g[p][q] * c[q])))) AS rss FROM ({work})"""
    steps = "WITH RECURSIVE " + _products_sql(False).strip().removeprefix("WITH ") + f""",
steps AS (
  SELECT brand, model, n, g, b, yy, 0 AS i, list_transform({r}, lambda p: CAST(0 AS DOUBLE)) AS coef, list_transform({r}, lambda p: CAST(1 AS DOUBLE)) AS lam,
    1 / (yy / n + 1e-12) AS alpha, false AS done FROM mo, (VALUES ('bayesian_ridge'), ('ard')) AS m(model)
  UNION ALL
  SELECT brand, model, n, g, b, yy, i + 1, c, list_transform({r}, lambda p: CASE WHEN model = 'bayesian_ridge' THEN (list_sum(gam) + 2e-6) / ({dot('c', 'c')} + 2e-6)
      WHEN kept[p] THEN (gam[p] + 2e-6) / (c[p] * c[p] + 2e-6) ELSE lam[p] END),
    (n - list_sum(gam) + 2e-6) / (rss + 2e-6), i > 0 AND list_sum(list_transform({r}, lambda k: abs(before[k] - c[k]))) < 1e-3 FROM ({work}))"""
    return _coef_out(steps)


def _linear_rows(spark, sf):
    return features(spark, sf).where("rn >= 7 and rn < n - 364")


@register("m3_m4_bayes_features", _bayes_sql())
def q_bayes_features(spark, sf):
    """Bayesian ridge and ARD of each brand's discount on five lag, rolling and calendar features."""
    got = L.linear_fits(_linear_rows(spark, sf), LINEAR_FEATS, "label", ["brand"], ["bayesian_ridge", "ard"])
    return got.withColumn("coef", F.round("coef", D) + 0.0)


ALPHA, SWEEPS = 0.002, 1500


def _lars_sql() -> str:
    """Coordinate descent, sweep by sweep, to the same minimum."""
    d = len(LINEAR_FEATS)
    r = f"range(1, {d + 1})"
    work = "SELECT * FROM steps WHERE i < " + str(SWEEPS)
    for p in range(1, d + 1):
        rho = f"(b[{p}] - list_sum(list_transform({r}, lambda k: CASE WHEN k = {p} THEN 0 ELSE g[{p}][k] * coef[k] END))) / n"
        work = f"""SELECT * EXCLUDE (coef, rho), list_transform({r}, lambda k: CASE WHEN k <> {p} THEN coef[k] WHEN g[{p}][{p}] > 1e-9 * n AND abs(rho) > {ALPHA} THEN sign(rho) * (abs(rho) - {ALPHA}) / (g[{p}][{p}] / n) ELSE 0 END) AS coef
    FROM (SELECT *, {rho} AS rho FROM ({work}))"""
    steps = "WITH RECURSIVE " + _products_sql(True).strip().removeprefix("WITH ") + f""",
steps AS (
  SELECT brand, 'lasso_lars' AS model, n, g, b, 0 AS i, list_transform({r}, lambda p: CAST(0 AS DOUBLE)) AS coef FROM mo
  UNION ALL SELECT brand, model, n, g, b, i + 1, coef FROM ({work}))"""
    return _coef_out(steps)


@register("m2_lars_features", _lars_sql())
def q_lars_features(spark, sf):
    """Lasso of each brand's discount on five features by the least-angle path."""
    got = L.linear_fits(_linear_rows(spark, sf), LINEAR_FEATS, "label", ["brand"], ["lasso_lars"], ALPHA, scaled=True)
    return got.withColumn("coef", F.round("coef", D) + 0.0)
