"""AdaBoost.R2 on weighted bootstrap samples against brute force and a planted signal."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dealcast.operators import boosting


def draw(*parts):
    one = lambda *p: int(hashlib.md5("|".join(map(str, p)).encode()).hexdigest()[:8], 16) / 2 ** 32
    return one(*parts) + one(*parts, "low") / 2 ** 32


def hits(weights, draws, seed, sample):
    end = np.cumsum(weights) / np.sum(weights)
    out = np.zeros(len(weights), int)
    for j in range(1, draws + 1):
        out[min(np.searchsorted(end, draw(seed, sample, j), side="right"), len(end) - 1)] += 1
    return out


@pytest.mark.parametrize("kind", ["equal", "hot", "zeros"])
def test_weighted_bootstrap_inverts_the_running_sums(spark, kind):
    n = 300
    weights = {"equal": np.ones(n), "hot": np.where(np.arange(n) == 117, 500.0, 0.5 + np.arange(n) % 7), "zeros": (np.arange(n) % 3).astype(float)}[kind]
    df = spark.createDataFrame([(i, float(w)) for i, w in enumerate(weights)], "o long, w double").repartition(7)
    got = {r.o: r.hits for r in boosting.weighted_bootstrap(df, "o", "w", 1000, 3, 5).collect()}
    assert [got[i] for i in range(n)] == hits(weights, 1000, 3, 5).tolist()
    assert sum(got.values()) == 1000


def planted(n, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 12, (n, 3)).astype(float)
    return x, np.where(x[:, 0] > 5, 8.0, 1.0) + np.where(x[:, 1] > 8, 3.0, 0.0) + (rng.random(n) < 0.05) * 6


def plain(x, y, seed, rounds, depth):
    """AdaBoost.R2 row by row on values that are their own bins; rows in the order of (x, y)."""
    order = sorted(range(len(y)), key=lambda i: (*x[i], y[i]))
    x, y, w, out = x[order], y[order], np.ones(len(y)), []

    def grow(rows, h, left):
        value = np.sum(h[rows] * y[rows]) / np.sum(h[rows])
        best = (0.0, None)
        for f in range(x.shape[1]) if left else ():
            own = np.unique(x[rows, f])
            for a, b in zip(own, own[1:]):
                go = x[rows, f] <= (a + b) / 2
                score = lambda r: np.sum(h[r] * y[r]) ** 2 / np.sum(h[r])
                gain = round(score(rows[go]) + score(rows[~go]) - score(rows), 9)
                if gain > best[0]:
                    best = (gain, (f, (a + b) / 2))
        if best[1] is None:
            return lambda v: value
        f, cut = best[1]
        lo, hi = grow(rows[x[rows, f] <= cut], h, left - 1), grow(rows[x[rows, f] > cut], h, left - 1)
        return lambda v: lo(v) if v[f] <= cut else hi(v)

    for r in range(rounds):
        h = hits(w, len(y), seed, r).astype(float)
        tree = grow(np.flatnonzero(h > 0), h, depth)
        err = np.abs(np.array([tree(v) for v in x]) - y)
        loss = np.sum(w * err) / np.sum(w) / err.max()
        if loss >= 0.5 and out:
            break
        out.append((tree, math.log((1 - loss) / loss)))
        w = w * (loss / (1 - loss)) ** (1 - err / err.max())
    return out


def test_rounds_equal_a_plain_version(spark):
    x, y = planted(120)
    df = spark.createDataFrame([(v.tolist(), float(t)) for v, t in zip(x, y)], "x array<double>, y double").repartition(3)
    model = boosting.adaboost_r2(df, 3, 2, seed=9)
    want = plain(x, y, 9, 3, 2)
    assert np.allclose(model.weights, [a for _, a in want], atol=1e-9)
    got = {tuple(r.x): r.prediction for r in model.transform(df, F.col("x")).collect()}
    for v in x:
        values = sorted((t(v), a) for t, a in want)
        upto = np.cumsum([a for _, a in values])
        assert abs(got[tuple(v)] - values[int(np.argmax(upto >= upto[-1] / 2))][0]) < 1e-9


def test_planted_signal_and_edge_cases(spark):
    x, y = planted(400)
    df = spark.createDataFrame([(v.tolist(), float(t)) for v, t in zip(x, y)] + [([1.0, None, 2.0], None)], "x array<double>, y double")
    model = boosting.adaboost_r2(df, 8, 2)
    test = spark.createDataFrame([([2.0, 3.0, 1.0], 1.0), ([9.0, 3.0, 1.0], 8.0), ([9.0, 11.0, 1.0], 11.0)], "x array<double>, y double")
    assert all(abs(r.prediction - r.y) < 0.8 for r in model.transform(test, F.col("x")).collect())
    assert len(model.rounds) > 1 and max(model.losses[:len(model.rounds)]) < 0.5

    flat = boosting.adaboost_r2(df.withColumn("y", F.lit(2.5)), 5)  # one tree fits all
    assert flat.weights == [1.0] and {r.prediction for r in flat.transform(test, F.col("x")).collect()} == {2.5}
    none = boosting.adaboost_r2(df.limit(0), 5)
    assert len(none.rounds) == 1 and [r.prediction for r in none.transform(test, F.lit([1.0, 2.0])).collect()] == [0.0] * 3
