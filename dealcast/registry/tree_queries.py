"""Registered queries: exact trees, random-cut trees, second-order boosting, with SQL that grows the same trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from dealcast.functions.draws import sql_uniform_draw
from dealcast.operators import features as X
from dealcast.operators import trees
from dealcast.operators.splits import split_random
from dealcast.registry.base import D, register
from dealcast.registry.panel_queries import FEAT_BASE, features

FEATS = X.NUMERIC_FEATURES
NAMES = "(SELECT unnest(range(0, {n})) AS f, unnest([{names}]) AS feature)".format(n=len(FEATS), names=", ".join(f"'{f}'" for f in FEATS))
ARRAY = "[" + ", ".join(f"CAST({f} AS DOUBLE)" for f in FEATS) + "]"


def _grow_sql(p: str, depth: int, lam: float = 0.0, min_weight: float = 0.0, test: bool = True) -> str:
    """CTEs that grow a tree from {p}0 (node, h, g, x): {p}bs (splits), {p}vals (values), {p}out (test rows' values, from {p}t0)."""
    out, tail = [], f" + {lam}" if lam else ""
    for k in range(depth):
        out.append(f"""
{p}ct{k} AS (SELECT node, f, v, sum(h) AS h, sum(g) AS g, count(*) AS n FROM (SELECT node, h, g, unnest(range(0, len(x))) AS f, unnest(x) AS v FROM {p}{k}) GROUP BY ALL),
{p}rn{k} AS (SELECT node, f, v, sum(h) OVER w AS hl, sum(g) OVER w AS gl, sum(h) OVER a AS hh, sum(g) OVER a AS gg, lead(v) OVER (PARTITION BY node, f ORDER BY v) AS nv
  FROM {p}ct{k} WINDOW w AS (PARTITION BY node, f ORDER BY v), a AS (PARTITION BY node, f)),
{p}gn{k} AS (SELECT node, f, (v + nv) / 2 AS cut, round(gl * gl / (hl{tail}) + (gg - gl) * (gg - gl) / (hh - hl{tail}) - gg * gg / (hh{tail}), 9) AS gain
  FROM {p}rn{k} WHERE nv IS NOT NULL AND least(hl, hh - hl) >= {min_weight}),
{p}bs{k} AS (SELECT node, f, cut, gain FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, cut) AS rk FROM {p}gn{k} WHERE gain > 0) WHERE rk = 1),
{p}{k + 1} AS (SELECT 2 * s.node + CAST(s.x[b.f + 1] > b.cut AS INT) AS node, h, g, x FROM {p}{k} s JOIN {p}bs{k} b ON s.node = b.node),""")
        if test:
            out.append(f"""
{p}t{k + 1} AS (SELECT s.* EXCLUDE (node), 2 * s.node + CAST(s.x[b.f + 1] > b.cut AS INT) AS node FROM {p}t{k} s JOIN {p}bs{k} b ON s.node = b.node),""")
    every = lambda t: " UNION ALL ".join(f"SELECT * FROM {p}{t}{k}" for k in range(depth + (t != "bs")))
    out.append(f"""
{p}bs AS ({every('bs')}),
{p}vals AS (SELECT node, count(*) AS n, sum(g) / (sum(h){tail}) AS value FROM ({every('')}) GROUP BY node),""")
    if test:
        out.append(f"""
{p}out AS (SELECT t.*, v.value FROM ({every('t')}) t JOIN {p}vals v ON t.node = v.node WHERE t.node NOT IN (SELECT node FROM {p}bs)),""")
    return "".join(out).rstrip(",")


def _nodes(spark, model, names, tree_name="tree"):
    """One row per node: what it holds and how it's split."""
    rows = []
    for (tree, node), (value, n) in model.values.items():
        f, cut, gain = model.splits.get((tree, node), (None, None, None))
        rows.append((tree, node, n, value, None if f is None else names[f], cut, gain))
    got = spark.createDataFrame(rows, f"{tree_name} int, node int, n_rows long, value double, feature string, cut double, gain double")
    return got.select(tree_name, "node", "n_rows", F.round("value", D).alias("value"), "feature", F.round("cut", D).alias("cut"), F.round("gain", D).alias("gain"))


NODES_SQL = f"""
SELECT CAST(v.node AS INT) AS node, v.n AS n_rows, round(v.value, 6) AS value, names.feature, round(b.cut, 6) AS cut, round(b.gain, 6) AS gain
FROM svals v LEFT JOIN sbs b ON v.node = b.node LEFT JOIN {NAMES} names ON b.f = names.f"""
DEPTH = 2

# ---------------------------------------------------------------- M6: regression
REG_SQL = FEAT_BASE.rstrip() + f""",
reg AS (SELECT brand, CAST(label AS DOUBLE) AS y, {ARRAY} AS x, CASE WHEN rn = n THEN 'last' WHEN rn >= n - 364 THEN 'test' WHEN rn >= 7 THEN 'train' ELSE 'skip' END AS split FROM feat),
s0 AS (SELECT 1 AS node, CAST(1 AS DOUBLE) AS h, y AS g, x FROM reg WHERE split = 'train'),
st0 AS (SELECT brand, y, x, 1 AS node FROM reg WHERE split = 'test'),"""


def _reg(spark, sf):
    from dealcast.operators.splits import split_tail
    f = split_tail(features(spark, sf)).where(F.col("split").isin("train", "test"))
    f = f.select("brand", "posted_date", "split", F.col("label").cast("double").alias("y"), trees.feature_array(FEATS).alias("x"))
    return f.where("split = 'train'"), f.where("split = 'test'")


def _tree(train):
    return trees.grown(train.select(F.lit(0).alias("tree"), F.lit(1.0).alias("h"), F.col("y").alias("g"), "x"), 1, DEPTH)


def _register_tree(name: str, base: str, frames, what: str):
    grow = base + _grow_sql("s", DEPTH)

    @register(f"{name}_exact_tree", grow + NODES_SQL)
    def nodes(spark, sf):
        train, _ = frames(spark, sf)
        return _nodes(spark, _tree(train), FEATS).drop("tree")

    @register(f"{name}_exact_tree_scores", grow + """
SELECT brand, count(*) AS n_rows, round(avg((value - y) * (value - y)), 6) AS mse, round(avg(CAST((value >= 0.5) = (y >= 0.5) AS INT)), 6) AS accuracy FROM sout GROUP BY brand""")
    def scores(spark, sf):
        train, test = frames(spark, sf)
        got = trees.predicted(test, _tree(train), F.col("x"))
        e = F.col("prediction") - F.col("y")
        right = ((F.col("prediction") >= 0.5) == (F.col("y") >= 0.5)).cast("int")
        return got.groupBy("brand").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.avg(e * e), D).alias("mse"), F.round(F.avg(right), D).alias("accuracy"))

    nodes.__doc__ = f"The {what} of depth {DEPTH} over every cut: its nodes."
    scores.__doc__ = f"The {what} of depth {DEPTH} on the test rows of each brand."


_register_tree("m6", REG_SQL, _reg, "regression tree of the discount")

# ---------------------------------------------------------------- M16: gift days
_day = sql_uniform_draw("concat_ws('|', '42', CAST(posted_date AS VARCHAR))")
CLS_BASE = FEAT_BASE.rstrip() + f""",
cls AS (SELECT brand, CAST(y AS DOUBLE) AS y, {ARRAY} AS x, {", ".join(FEATS)}, row_number() OVER (PARTITION BY brand ORDER BY {_day}, posted_date)
  <= floor(count(*) OVER (PARTITION BY brand) * CAST(0.7 AS DOUBLE)) AS train FROM dd),"""
CLS_SQL = CLS_BASE + """
s0 AS (SELECT 1 AS node, CAST(1 AS DOUBLE) AS h, y AS g, x FROM cls WHERE train),
st0 AS (SELECT brand, y, x, 1 AS node FROM cls WHERE NOT train),"""


def _cls_rows(spark, sf):
    dd = split_random(X.filter_deal_days(features(spark, sf)), ["posted_date"], 0.7, 42, ["brand"])
    return dd.withColumn("y", F.col("gwp").cast("int").cast("double"))


def _cls(spark, sf):
    dd = _cls_rows(spark, sf).select("brand", "posted_date", "split", "y", trees.feature_array(FEATS).alias("x"))
    return dd.where("split = 'train'"), dd.where("split = 'test'")


_register_tree("m16", CLS_SQL, _cls, "classification tree of gift days")

# ---------------------------------------------------------------- M11: random cuts
M11_TREES, M11_SEED = 20, 11


@register("m11_random_cuts", REG_SQL[:REG_SQL.index('s0 AS')] + f"""
tr AS (SELECT y, x FROM reg WHERE split = 'train'),
lg AS (SELECT y, unnest(range(0, len(x))) AS f, unnest(x) AS v FROM tr),
ends AS (SELECT f, min(v) AS lo, max(v) AS hi FROM lg GROUP BY f HAVING min(v) < max(v)),
cuts AS (SELECT CAST(t AS INT) AS tree, f, lo + {sql_uniform_draw(f"concat_ws('|', '{M11_SEED}', CAST(t AS VARCHAR), '1', CAST(f AS VARCHAR))")} * (hi - lo) AS cut FROM ends, range({M11_TREES}) AS r(t)),
parts AS (SELECT tree, c.f, cut, sum(y) AS gg, count(*) AS hh, coalesce(sum(y) FILTER (WHERE v <= cut), 0) AS gl, count(*) FILTER (WHERE v <= cut) AS hl FROM cuts c JOIN lg ON c.f = lg.f GROUP BY ALL),
gains AS (SELECT *, round(gl * gl / hl + (gg - gl) * (gg - gl) / (hh - hl) - gg * gg / hh, 9) AS gain FROM parts WHERE hl > 0 AND hl < hh),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY gain DESC, f) AS rk FROM gains) WHERE rk = 1 AND gain > 0)
SELECT tree, names.feature, round(cut, 6) AS cut, round(gain, 6) AS gain, hh AS n_rows, hl AS n_left, round(gl / hl, 6) AS left_value, round((gg - gl) / (hh - hl), 6) AS right_value
FROM best JOIN {NAMES} names ON best.f = names.f""")
def q_random_cuts(spark, sf):
    """Extra trees of one level: the cut drawn for every tree and feature, and the best of them."""
    train, _ = _reg(spark, sf)
    m = trees.random_grown(train.select(F.monotonically_increasing_id().alias("row"), "y", "x"), len(FEATS), M11_TREES, 1, seed=M11_SEED)
    rows = [(t, FEATS[f], cut, gain, m.values[t, 1][1], m.values[t, 2][1], m.values[t, 2][0], m.values[t, 3][0]) for (t, _), (f, cut, gain) in m.splits.items()]
    got = spark.createDataFrame(rows, "tree int, feature string, cut double, gain double, n_rows long, n_left long, left_value double, right_value double")
    return got.select("tree", "feature", *[F.round(c, D).alias(c) for c in ("cut", "gain")], "n_rows", "n_left", *[F.round(c, D).alias(c) for c in ("left_value", "right_value")])


# ---------------------------------------------------------------- M19, M20: second-order boosting
ROUNDS, RATE, LAM, BINS = 2, 0.3, 1.0, 16


def _boost_sql() -> str:
    shares = ", ".join(str(i / BINS) for i in range(1, BINS))
    out = CLS_BASE + f"""
cuts AS (SELECT f, list_sort(list_distinct(quantile_cont(v, [{shares}]))) AS c FROM (SELECT unnest(range(0, len(x))) AS f, unnest(x) AS v FROM cls WHERE train) GROUP BY f),
every AS (SELECT list(c ORDER BY f) AS cs FROM cuts),
binned AS (SELECT brand, y, train, list_transform(range(1, len(x) + 1), lambda j: CAST(len(list_filter(cs[j], lambda c: c < x[j])) AS DOUBLE)) AS x FROM cls, every),
m0 AS (SELECT *, CAST(0 AS DOUBLE) AS m FROM binned),"""
    for r in range(ROUNDS):
        p = f"r{r}_"
        out += f"""
{p}0 AS (SELECT 1 AS node, (1 / (1 + exp(-m))) * (1 - 1 / (1 + exp(-m))) AS h, y - 1 / (1 + exp(-m)) AS g, x FROM m{r} WHERE train),
{p}t0 AS (SELECT brand, y, train, x, m, 1 AS node FROM m{r}),""" + _grow_sql(p, DEPTH, LAM, 1.0) + f""",
m{r + 1} AS (SELECT brand, y, train, x, m + {RATE} * value AS m FROM {p}out),"""
    return out.rstrip(",")


def _boosted(spark, sf):
    rows = _cls_rows(spark, sf)
    return trees.boosted(rows.where("split = 'train'"), FEATS, "y", ROUNDS, RATE, DEPTH, LAM, bins=BINS), rows.where("split = 'test'")


@register("m19_second_order_boosting", _boost_sql() + f"""
SELECT brand, count(*) AS n_rows, round(avg(m), 6) AS mean_margin, round(avg(CAST((m >= 0) = (y = 1) AS INT)), 6) AS accuracy,
  round(avg(CASE WHEN y = 1 THEN ln(1 + exp(-m)) ELSE ln(1 + exp(m)) END), 6) AS log_loss FROM m{ROUNDS} WHERE NOT train GROUP BY brand""")
def q_second_order(spark, sf):
    """Gift days by two rounds of second-order boosting: loss and accuracy on each brand's test days."""
    model, test = _boosted(spark, sf)
    m, y = F.col("margin"), F.col("y")
    loss = F.when(y == 1, F.log(1 + F.exp(-m))).otherwise(F.log(1 + F.exp(m)))
    return model.margin(test).groupBy("brand").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.avg(m), D).alias("mean_margin"), F.round(F.avg(((m >= 0) == (y == 1)).cast("int")), D).alias("accuracy"),
        F.round(F.avg(loss), D).alias("log_loss"))


@register("m20_boosting_gains", _boost_sql() + f"""
SELECT feature, round(avg(gain), 6) AS avg_gain, count(*) AS n_splits FROM ({" UNION ALL ".join(f"SELECT f, gain FROM r{r}_bs" for r in range(ROUNDS))}) g
JOIN {NAMES} names ON g.f = names.f GROUP BY feature""")
def q_boosting_gains(spark, sf):
    """Average gain of each feature over the splits of the boosted trees."""
    model, _ = _boosted(spark, sf)
    return spark.createDataFrame([(f, g, n) for f, (g, n) in model.gains().items()], "feature string, avg_gain double, n_splits long") \
        .withColumn("avg_gain", F.round("avg_gain", D))


# ---------------------------------------------------------------- M7: AdaBoost.R2 on weighted bootstrap samples
ADA_SEED = 7


def _adaboost_sql() -> str:
    shares = ", ".join(str(i / BINS) for i in range(1, BINS))
    going = lambda r: " AND ".join([f"(SELECT loss FROM b{k}_st) < 0.5" for k in range(r)] or ["true"])
    out = FEAT_BASE.rstrip() + f""",
reg AS (SELECT * FROM (SELECT brand, posted_date, CAST(label AS DOUBLE) AS y, {ARRAY} AS x, CASE WHEN rn = n THEN 'last' WHEN rn >= n - 364 THEN 'test' WHEN rn >= 7 THEN 'train' ELSE 'skip' END AS split FROM feat)
  WHERE split IN ('train', 'test')),
cuts AS (SELECT f, list_sort(list_distinct(quantile_cont(v, [{shares}]))) AS c FROM (SELECT unnest(range(0, len(x))) AS f, unnest(x) AS v FROM reg WHERE split = 'train') GROUP BY f),
every AS (SELECT list(c ORDER BY f) AS cs FROM cuts),
a0 AS (SELECT brand, posted_date, y, split, CASE WHEN split = 'train' THEN CAST(1 AS DOUBLE) END AS w, CAST([] AS STRUCT(v DOUBLE, a DOUBLE)[]) AS p,
  list_transform(range(1, len(x) + 1), lambda j: CAST(len(list_filter(cs[j], lambda c: c < x[j])) AS DOUBLE)) AS x FROM reg, every),"""
    for r in range(ROUNDS):
        p, key = f"b{r}_", f"concat_ws('|', '{ADA_SEED}', '{r}', CAST(j AS VARCHAR)"
        out += f"""
{p}ends AS (SELECT *, sum(w) OVER (ORDER BY brand, posted_date) / sum(w) OVER () AS hi FROM a{r} WHERE split = 'train'),
{p}at AS (SELECT {sql_uniform_draw(key + ')')} + {sql_uniform_draw(key + ", 'low')")} / 4294967296.0 AS u FROM (SELECT unnest(range(1, count(*) + 1)) AS j FROM {p}ends)),
{p}0 AS (SELECT 1 AS node, CAST(count(*) AS DOUBLE) AS h, count(*) * any_value(y) AS g, any_value(x) AS x
  FROM (SELECT e.* FROM {p}at d ASOF JOIN {p}ends e ON d.u < e.hi) GROUP BY brand, posted_date),
{p}t0 AS (SELECT *, 1 AS node FROM a{r}),""" + _grow_sql(p, DEPTH) + f""",
{p}st AS (SELECT max(abs(value - y)) AS worst, sum(w) AS tot, sum(w * abs(value - y)) / (sum(w) * max(abs(value - y))) AS loss FROM {p}out WHERE split = 'train'),
a{r + 1} AS (SELECT brand, posted_date, y, split, w / tot * pow(loss / (1 - loss), 1 - abs(value - y) / worst) AS w,
  {f"CASE WHEN loss < 0.5 AND {going(r)} THEN list_append(p, {{'v': value, 'a': ln((1 - loss) / loss)}}) ELSE p END" if r else "[{'v': value, 'a': CASE WHEN loss < 0.5 THEN ln((1 - loss) / loss) ELSE 1 END}]"} AS p, x FROM {p}out, {p}st),"""
    weight = "list_sum(list_transform(list_filter(p, lambda e: e.v <= c.v), lambda e: e.a))"
    return out + f"""
fin AS (SELECT brand, y, list_min(list_transform(list_filter(p, lambda c: {weight} >= 0.5 * list_sum(list_transform(p, lambda e: e.a))), lambda c: c.v)) AS value FROM a{ROUNDS} WHERE split = 'test')
SELECT brand, count(*) AS n_rows, round(avg(value), 6) AS mean_forecast, round(avg((value - y) * (value - y)), 6) AS mse, round(avg(abs(value - y)), 6) AS mae,
  {", ".join(f"CASE WHEN {going(r)} THEN (SELECT round(loss, 6) FROM b{r}_st) END AS loss_{r + 1}" for r in range(ROUNDS))} FROM fin GROUP BY brand"""


@register("m7_resampled_boosting", _adaboost_sql())
def q_resampled_boosting(spark, sf):
    """Discount by two rounds of AdaBoost.R2, each on a weighted bootstrap sample: errors on each brand's test year and the rounds' average losses
    (a half or more ends the boosting: rounds after it are null, and it counts only as the first)."""
    from dealcast.operators.boosting import adaboost_r2
    train, test = _reg(spark, sf)
    model = adaboost_r2(train, ROUNDS, DEPTH, bins=BINS, seed=ADA_SEED, keys=["brand", "posted_date"])
    e = F.col("prediction") - F.col("y")
    return model.transform(test, F.col("x")).groupBy("brand").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.avg("prediction"), D).alias("mean_forecast"), F.round(F.avg(e * e), D).alias("mse"), F.round(F.avg(F.abs(e)), D).alias("mae"),
        *[F.round(F.lit(loss).cast("double"), D).alias(f"loss_{r + 1}") for r, loss in enumerate([*model.losses, *[None] * (ROUNDS - len(model.losses))])])


# ---------------------------------------------------------------- M12: logistic regression by Newton steps
LOGIT_FEATS, NEWTON_STEPS = ["t_1", "t_7", "mean_7", "max_30", "month"], 9


def _newton_sql() -> str:
    k = len(LOGIT_FEATS) + 1
    r = f"range(1, {k + 1})"
    out = CLS_BASE + f"""
xs AS (SELECT y, [{", ".join(f"CAST({f} AS DOUBLE)" for f in LOGIT_FEATS)}, 1.0] AS x FROM cls WHERE train),
w0 AS (SELECT list_transform({r}, lambda j: CAST(0 AS DOUBLE)) AS w),"""
    for s in range(NEWTON_STEPS):
        h = ", ".join("[" + ", ".join(f"sum(p * (1 - p) * x[{i}] * x[{j}]){' + 1' if i == j < k else ''}" for j in range(1, k + 1)) + f", sum((p - y) * x[{i}]){f' + any_value(w[{i}])' if i < k else ''}]" for i in range(1, k + 1))
        work = f"SELECT any_value(w) AS w, [{h}] AS a FROM (SELECT *, 1 / (1 + exp(-list_sum(list_transform({r}, lambda j: w[j] * x[j])))) AS p FROM xs, w{s})"
        for q in range(1, k + 1):
            work = f"""SELECT w, list_transform({r}, lambda i: list_transform(range(1, {k + 2}), lambda j: CASE WHEN i = {q} THEN a[{q}][j] / a[{q}][{q}] ELSE a[i][j] - a[i][{q}] * a[{q}][j] / a[{q}][{q}] END)) AS a FROM ({work})"""
        out += f"\nw{s + 1} AS (SELECT list_transform({r}, lambda j: w[j] - a[j][{k + 1}]) AS w FROM ({work})),"
    names = ", ".join(f"'{f}'" for f in [*LOGIT_FEATS, "(intercept)"])
    return out.rstrip(",") + f"\nSELECT unnest([{names}]) AS feature, round(unnest(w), 6) AS coef FROM w{NEWTON_STEPS}"


@register("m12_newton_logit", _newton_sql())
def q_newton(spark, sf):
    """Ridge-penalised logistic regression of gift days on five features: its coefficients.

    Where all deal days are gift days (no optimum) the intercept is that of the SQL's nine steps.
    """
    from dealcast.operators.linear import newton_logit
    coef, intercept = newton_logit(_cls_rows(spark, sf).where("split = 'train'"), LOGIT_FEATS, "y", max_steps=NEWTON_STEPS)
    return spark.createDataFrame([*zip(LOGIT_FEATS, coef), ("(intercept)", intercept)], "feature string, coef double").withColumn("coef", F.round("coef", D))
