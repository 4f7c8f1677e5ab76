"""Robust and linear models, exact quantiles and the tree grower against brute force and planted signals."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dealcast.operators import linear, robust, trees
from dealcast.operators import models as M
from dealcast.operators.ordered import quantiles


# ---------------------------------------------------------------- order statistics, Theil-Sen
def test_quantiles_equal_numpy_without_a_percentile_buffer(spark):
    rnd = random.Random(1)
    rows = [(g, None if rnd.random() < 0.1 else float(rnd.randint(0, 9)) / (1 + rnd.randint(0, 2))) for g in ("a", "b", None) for _ in range(150)] + [("one", 4.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    shares = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    out = quantiles(df, ["g"], "v", shares)
    assert "percentile" not in out._jdf.queryExecution().toString()
    got = {r.g: (r.n, r.cuts) for r in out.collect()}
    assert set(got) == {"a", "b", None, "one"}
    for g, (n, cuts) in got.items():
        own = [v for k, v in rows if k == g and v is not None]
        assert n == len(own) and np.allclose(cuts, np.quantile(own, shares), atol=1e-12)
    whole = quantiles(df, [], "v", [0.5]).first()
    assert whole.cuts[0] == np.median([v for _, v in rows if v is not None])


def test_inversions_by_merge_sort():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 3, 8, 63, 64, 65, 200):
        z = rng.integers(0, 12, n).astype(float)
        assert robust.not_above(z) == sum(z[j] <= z[i] for i in range(n) for j in range(i + 1, n))


@pytest.mark.parametrize("size", [8192, 16])
def test_theil_sen_is_the_median_of_pairwise_slopes(spark, monkeypatch, size):
    monkeypatch.setattr(robust, "SLICE", size)
    rng, rows = np.random.default_rng(4), []
    for g, n in (("ties", 90), ("line", 31), ("two", 2), ("one", 1), ("same x", 70)):
        for i in range(n):
            x = float(i if g != "same x" else rng.integers(0, 20))
            rows.append((g, x, 3 - 0.7 * x + float(rng.normal()) if g == "line" else float(rng.integers(0, 5)) / 10))
    rows += [("flat", 1.0, 1.0), ("flat", 1.0, 2.0), ("ties", None, 1.0), ("ties", 3.0, float("nan"))]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    plan = robust.theil_sen(df, "x", "y", ["g"])
    got = {r.g: (r.slope, r.intercept) for r in plan.collect()}
    for g in {r[0] for r in rows}:
        p = [(x, y) for k, x, y in rows if k == g and x is not None and y == y]
        slopes = [(d - b) / (c - a) for (a, b), (c, d) in itertools.combinations(p, 2) if a != c]
        if not slopes:
            assert got[g] == (None, None)
        else:
            m = float(np.median(slopes))
            assert got[g][0] == pytest.approx(m, abs=1e-11) and got[g][1] == pytest.approx(np.median([y - m * x for x, y in p]), abs=1e-9)


# ---------------------------------------------------------------- models from one Gramian
def _frame(spark, n=300, d=5, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) + 100
    y = x @ np.array([1.5, 0, -2.0, 0, 0.3][:d]) + rng.normal(size=n) * 0.5
    feats = [f"f{k}" for k in range(d)]
    rows = [("a" if i % 3 else None, *map(float, x[i]), float(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "g string, " + ", ".join(f"{f} double" for f in feats) + ", y double").repartition(6), feats, rows


def test_gramian_equals_numpy(spark):
    df, feats, rows = _frame(spark)
    extra = spark.createDataFrame([("a", None, *[1.0] * 5)], df.schema)
    for r in linear.gramian(df.unionByName(extra), feats, "y", ["g"]).collect():
        v = np.array([row[1:] for row in rows if row[0] == r.g])
        assert r.n == len(v) and np.allclose(r.mean, v.mean(axis=0))
        assert np.allclose(np.array(r.products).reshape(6, 6), (v - v.mean(axis=0)).T @ (v - v.mean(axis=0)), rtol=1e-9)


@pytest.mark.parametrize("alpha", [0.001, 0.05, 0.5, 5.0, 1e9])
def test_lars_meets_the_optimality_conditions(alpha):
    rng = np.random.default_rng(7)
    for _ in range(20):
        x = rng.normal(size=(60, 8)) @ rng.normal(size=(8, 8))
        x[:, 5] = 0.0  # constant
        y = x @ rng.normal(size=8) + rng.normal(size=60)
        x, y = x - x.mean(axis=0), y - y.mean()
        w = linear.lars(x.T @ x, x.T @ y, 60, alpha)
        slope = x.T @ (y - x @ w) / 60
        assert np.all(np.abs(slope) <= alpha + 1e-8)
        assert np.allclose(slope[w != 0], alpha * np.sign(w[w != 0]), atol=1e-8) and w[5] == 0


def test_evidence_of_one_feature_equals_the_trend_form(spark):
    df, feats, _ = _frame(spark, d=1)
    for name, ard in (("bayesian_ridge", False), ("ard", True)):
        many = {r.g: r.coef for r in linear.linear_fits(df, feats, "y", ["g"], [name]).where("feature is not null").collect()}
        one = {r.g: r.slope for r in M.bayes_trend(df, "f0", "y", ["g"], ard=ard).collect()}
        assert many.keys() == one.keys() and all(many[g] == pytest.approx(one[g], rel=1e-9) for g in one)


def test_linear_models_find_the_planted_coefficients(spark):
    df, feats, _ = _frame(spark, n=3000)
    want = dict(zip(feats, (1.5, 0, -2.0, 0, 0.3)))
    got = linear.linear_fits(df, feats, "y", ["g"], ["bayesian_ridge", "ard", "lasso_lars"], alpha=1e-4)
    for r in got.where("feature is not null").collect():
        assert r.coef == pytest.approx(want[r.feature], abs=0.15), r


def test_newton_logit_has_no_gradient_left(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 3)) * [1, 20, 0.1] + [0, 5, 3]
    y = (rng.random(500) < 1 / (1 + np.exp(-(x @ [1, 0.1, -5] + 14)))).astype(float)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)] + [(None, 1.0, 1.0, 1.0)], "a double, b double, c double, y double")
    w, b = linear.newton_logit(df, ["a", "b", "c"], "y", ridge=0.5)
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.allclose(x.T @ (p - y) + 0.5 * np.array(w), 0, atol=1e-6) and abs((p - y).sum()) < 1e-6 and np.sign(w).tolist() == [1, 1, -1]


def test_newton_logit_ends_on_one_class(spark, monkeypatch):
    """No step is halved on the way to a certain class: one aggregation a step."""
    df = spark.createDataFrame([(float(i % 7), 1.0) for i in range(2000)], "a double, y double")
    runs, real = [], type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, *args: runs.append(1) or real(self, *args))
    w, b = linear.newton_logit(df, ["a"], "y", max_steps=45)
    assert len(runs) <= 46 and abs(w[0]) < 1e-9 and b > 30
    z = 0.0
    for _ in range(9):
        z += 1 + np.exp(-z)
    assert np.isclose(linear.newton_logit(df, ["a"], "y", max_steps=9)[1], z, atol=1e-9)


def test_trend_days_are_read_from_the_checkpoint(spark):
    from dealcast.registry.model_queries import _trend_data
    for days in _trend_data(spark, "/root/testdata/sf0.001"):
        assert not any("lineitem" in f for f in days.inputFiles())
        assert "Aggregate" not in days._jdf.queryExecution().optimizedPlan().toString()


# ---------------------------------------------------------------- trees
def plain_tree(x, y, depth, node=1):
    """Best cuts by trying them all: {node: (feature, cut, gain) or the value}."""
    out = {node: (float(y.mean()), len(y))}
    best = None
    if depth:
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for lo, hi in zip(values, values[1:]):
                left = x[:, f] <= lo
                gain = round(y[left].sum() ** 2 / left.sum() + y[~left].sum() ** 2 / (~left).sum() - y.sum() ** 2 / len(y), 9)
                if gain > 0 and (best is None or gain > best[0]):
                    best = (gain, f, (lo + hi) / 2 if lo > -np.inf else -np.inf)
    if best:
        gain, f, cut = best
        out[node] += (f, cut)
        right = x[:, f] > cut
        out |= plain_tree(x[~right], y[~right], depth - 1, 2 * node) | plain_tree(x[right], y[right], depth - 1, 2 * node + 1)
    return out


@pytest.mark.parametrize("binned", [False, True])
def test_grown_trees_equal_brute_force(spark, binned):
    rng = np.random.default_rng(9)
    data = [(rng.integers(0, 7, (n, 3)).astype(float), rng.integers(0, 4, n).astype(float)) for n in (80, 40, 1)]
    data[1][0][::7, 1] = -np.inf  # nulls of a feature
    rows = [(t, 1.0, float(v), [float(a) for a in r]) for t, (x, y) in enumerate(data) for r, v in zip(x, y)]
    df = spark.createDataFrame(rows, "tree int, h double, g double, x array<double>").repartition(4)
    model = trees.grown(df, 3, 3, binned=binned)
    for t, (x, y) in enumerate(data):
        want = plain_tree(x, y, 3)
        assert {n for k, n in model.values if k == t} == set(want)
        for node, w in want.items():
            value, n = model.values[t, node]
            assert n == w[1] and value == pytest.approx(w[0])
            assert (model.splits[t, node][:2] if (t, node) in model.splits else ()) == tuple(w[2:])
    one = trees.Trees(1, {(0, n): s for (t, n), s in model.splits.items() if t == 0}, {(0, n): v for (t, n), v in model.values.items() if t == 0})
    got = trees.predicted(df.where("tree = 0"), one, F.col("x")).select("g", "prediction").collect()
    want = plain_tree(*data[0], 3)
    leaf = [w[0] for w in want.values() if len(w) == 2]
    assert len(got) == 80 and all(min(abs(r.prediction - v) for v in leaf) < 1e-9 for r in got)


def test_limits_of_a_node(spark):
    rows = [(0, 1.0, float(k >= 9), [float(k)]) for k in range(10)]
    df = spark.createDataFrame(rows, "tree int, h double, g double, x array<double>")
    assert trees.grown(df, 1, 2).splits[0, 1][1] == 8.5
    assert trees.grown(df, 1, 1, min_rows=3).splits[0, 1][1] == 6.5
    assert not trees.grown(df, 1, 2, min_gain=1.0).splits and not trees.grown(df.limit(0), 1, 2).values


def test_random_cuts_are_drawn_per_node_and_lie_inside_it(spark):
    rng = np.random.default_rng(2)
    x, y = rng.random((400, 3)), rng.random(400)
    y = y * 0.1 + (x[:, 1] > 0.5)
    df = spark.createDataFrame([(k, float(y[k]), [float(a) for a in x[k]]) for k in range(400)], "row long, y double, x array<double>").repartition(3)
    m = trees.random_grown(df, 3, 6, 3, seed=5)
    cuts = [m.splits[t, n][:2] for t in range(6) for n in (1, 2, 3) if (t, n) in m.splits]
    assert len(set(cuts)) == len(cuts) > 12  # no two nodes share a threshold
    for t, table in enumerate(m.tables()):
        at = trees.reached(table, x)
        for leaf in np.unique(at):
            assert table[4][leaf] == pytest.approx(y[at == leaf].mean()) and m.values[t, int(table[5][leaf])][1] == (at == leaf).sum()
    again = trees.random_grown(df.repartition(7), 3, 6, 3, seed=5)
    assert m.splits.keys() == again.splits.keys() and all(m.splits[k][:2] == again.splits[k][:2] for k in m.splits)
    few = trees.random_grown(df, 3, 4, 2, n_tried=1, bootstrap=True, min_rows=5, seed=5)
    assert len({s[0] for s in few.splits.values()}) > 1 and min(n for _, n in few.values.values()) >= 5


def test_boosting_separates_a_planted_signal(spark):
    rng = np.random.default_rng(6)
    x = rng.random((600, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    df = spark.createDataFrame([(k, *map(float, r), float(t)) for k, (r, t) in enumerate(zip(x, y))], "id int, a double, b double, c double, y double")
    model = trees.boosted(df.where("id < 400"), ["a", "b", "c"], "y", n_rounds=4, max_depth=3, bins=16)
    out = model.margin(df.where("id >= 400")).select("margin", "y").collect()
    assert np.mean([(r.margin >= 0) == (r.y == 1) for r in out]) > 0.9
    gains = model.gains()
    assert gains["a"][0] > 5 * gains.get("b", (0.0,))[0] and gains["c"][0] > 5 * gains.get("b", (0.0,))[0]
