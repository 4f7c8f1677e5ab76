import random

import numpy as np
from pyspark.sql import functions as F

from dealcast.operators import metrics as E
from dealcast.operators.ordered import running_sums
from dealcast.operators.splits import split_random, stratified_folds, walk_forward_folds


def _tscv(n, n_splits, test_size=None, gap=0):
    ts = test_size or n // (n_splits + 1)
    for start in range(n - n_splits * ts, n, ts):
        yield list(range(0, max(start - gap, 0))), list(range(start, start + ts))


def test_walk_forward_matches_reference_generator(spark):
    for n, k, gap in ((100, 5, 0), (237, 20, 0), (90, 4, 3)):
        df = spark.createDataFrame([(i, n) for i in range(n)], "pos int, n_rows int")
        got = walk_forward_folds(df, k, gap=gap).collect()
        for f, (tr, te) in enumerate(_tscv(n, k, gap=gap)):
            assert sorted(r.pos for r in got if r.fold == f and r.role == "train") == tr
            assert sorted(r.pos for r in got if r.fold == f and r.role == "test") == te


def test_stratified_and_random_split(spark):
    rows = [("b", i, int(i % 4 == 0)) for i in range(200)]
    df = spark.createDataFrame(rows, "brand string, k int, y int")
    f = stratified_folds(df, "y", ["k"], k=10, seed=2, by=["brand"]).groupBy("fold", "y").count().collect()
    per = {}
    for r in f:
        per.setdefault(r.y, []).append(r["count"])
    assert sorted(per[1]) == [5] * 10 and sorted(per[0]) == [15] * 10
    s = split_random(df, ["k"], 0.7, 42, ["brand"]).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in s} == {"train": 140, "test": 60}


def test_running_sums_across_slices(spark):
    rnd = random.Random(5)
    rows = [(g, float(i), rnd.randint(0, 3)) for g in ("a", "b") for i in range(500)]
    df = spark.createDataFrame(rows, "g string, x double, v int")
    got = running_sums(df, ["g"], "x", ["v"], descending=True, num_slices=7).collect()
    for g in ("a", "b"):
        vals = sorted([(x, v) for gg, x, v in rows if gg == g], reverse=True)
        cum = np.cumsum([v for _, v in vals])
        m = {r.x: (r.cum_v, r.tot_v) for r in got if r.g == g}
        assert all(m[x] == (c, cum[-1]) for (x, _), c in zip(vals, cum))


def _brute_auc(y, s):
    pos = [si for yi, si in zip(y, s) if yi == 1]
    neg = [si for yi, si in zip(y, s) if yi == 0]
    tot = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg)
    return tot / (len(pos) * len(neg))


def _brute_ap(y, s):
    order = sorted(set(s), reverse=True)
    P = sum(y)
    ap, prev_r = 0.0, 0.0
    for t in order:
        tp = sum(1 for yi, si in zip(y, s) if si >= t and yi == 1)
        fp = sum(1 for yi, si in zip(y, s) if si >= t and yi == 0)
        r = tp / P
        ap += (r - prev_r) * tp / (tp + fp)
        prev_r = r
    return ap


def test_ranking_metrics_exact_with_ties(spark):
    rnd = random.Random(11)
    y = [rnd.random() < 0.3 for _ in range(400)]
    s = [round(rnd.random() * 0.5 + (0.3 if yi else 0.0), 1) for yi in y]  # heavy ties
    df = spark.createDataFrame([("m", int(a), b) for a, b in zip(y, s)], "model string, y int, score double")
    yi = [int(a) for a in y]
    auc = E.auroc(df, ["model"]).first().auroc
    assert abs(auc - _brute_auc(yi, s)) < 1e-12
    assert abs(E.roc_auc_trapezoid(df, ["model"]).first().roc_auc - auc) < 1e-12
    assert abs(E.average_precision(df, ["model"]).first().average_precision - _brute_ap(yi, s)) < 1e-12
    summ = E.score_summary(df.withColumn("pred", (F.col("score") >= 0.5).cast("int")), ["model"]).first()
    assert abs(summ.auroc - auc) < 1e-12
    tp = sum(1 for a, b in zip(yi, s) if a == 1 and b >= 0.5)
    fp = sum(1 for a, b in zip(yi, s) if a == 0 and b >= 0.5)
    fn = sum(yi) - tp
    assert abs(summ.f1 - 2 * tp / (2 * tp + fp + fn)) < 1e-12
    assert abs(summ.accuracy - sum(1 for a, b in zip(yi, s) if a == int(b >= 0.5)) / len(yi)) < 1e-12


def test_classification_report(spark):
    rows = [("m", 1, 1)] * 3 + [("m", 1, 0)] * 2 + [("m", 0, 0)] * 4 + [("m", 0, 1)]
    df = spark.createDataFrame(rows, "model string, y int, pred int")
    rep = {r.label: r for r in E.classification_report(df, ["model"]).collect()}
    assert abs(rep["1"].precision - 0.75) < 1e-12 and abs(rep["1"].recall - 0.6) < 1e-12
    assert abs(rep["0"].precision - 4 / 6) < 1e-12 and rep["0"].support == 5
    assert abs(rep["macro avg"].f1 - (rep["0"].f1 + rep["1"].f1) / 2) < 1e-12
    assert abs(rep["accuracy"].f1 - 0.7) < 1e-12 and rep["accuracy"].support == 10 and rep["accuracy"].precision is None


def _clf_curve(y, s):
    order = sorted(range(len(s)), key=lambda i: -s[i])
    ys, ss = [y[i] for i in order], [s[i] for i in order]
    idx = [i for i in range(len(ss) - 1) if ss[i] != ss[i + 1]] + [len(ss) - 1]
    cum = np.cumsum(ys)
    tps = [int(cum[i]) for i in idx]
    fps = [i + 1 - t for i, t in zip(idx, tps)]
    return fps, tps, [ss[i] for i in idx]


def _ref_roc(y, s):
    fps, tps, thr = _clf_curve(y, s)
    if len(fps) > 2:
        keep = [0] + [i for i in range(1, len(fps) - 1)
                      if fps[i + 1] - 2 * fps[i] + fps[i - 1] != 0 or tps[i + 1] - 2 * tps[i] + tps[i - 1] != 0] + [len(fps) - 1]
        fps, tps, thr = [fps[i] for i in keep], [tps[i] for i in keep], [thr[i] for i in keep]
    thr = [thr[0] + 1] + thr
    fps, tps = [0] + fps, [0] + tps
    return sorted((t, f / fps[-1], p / tps[-1]) for t, f, p in zip(thr, fps, tps))


def _ref_pr(y, s):
    fps, tps, thr = _clf_curve(y, s)
    last = tps.index(tps[-1])
    pts = [(thr[i], tps[i] / (tps[i] + fps[i]), tps[i] / tps[-1]) for i in range(last + 1)]
    return pts + [(None, 1.0, 0.0)]


def test_curves_match_reference_semantics(spark):
    rnd = random.Random(21)
    for trial in range(3):
        y = [int(rnd.random() < 0.35) for _ in range(300)]
        s = [round(rnd.random() * 0.6 + 0.3 * yi, 1 if trial else 2) for yi in y]
        df = spark.createDataFrame([("m", a, b) for a, b in zip(y, s)], "model string, y int, score double")
        got = sorted((r.threshold, r.fpr, r.tpr) for r in E.roc_points(df, ["model"]).collect())
        ref = _ref_roc(y, s)
        assert len(got) == len(ref)
        assert all(abs(a[0] - b[0]) < 1e-12 and abs(a[1] - b[1]) < 1e-12 and abs(a[2] - b[2]) < 1e-12 for a, b in zip(got, ref))
        pr = E.pr_points(df, ["model"]).collect()
        key = lambda t: (t[0] is None, t[0] if t[0] is not None else 0)
        got_pr = sorted(((r.threshold, r.precision, r.recall) for r in pr), key=key)
        ref_pr = sorted(_ref_pr(y, s), key=key)
        assert len(got_pr) == len(ref_pr)
        for a, b in zip(got_pr, ref_pr):
            assert a[0] == b[0] and abs(a[1] - b[1]) < 1e-12 and abs(a[2] - b[2]) < 1e-12
