import math
import random

import pytest

from dealcast.operators import neighbours as NB
from dealcast.operators.balance import class_balance, class_weights, smote
from dealcast.operators.neighbours import knn_join


def _d(a, b):
    acc = 0.0
    for x, y in zip(a, b):
        acc += (x - y) * (x - y)
    return math.sqrt(acc)


SEARCHES = [{}, {"block": 48}, {"method": "grid"}]


def _pts(spark, n, seed=1, dup=True):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = i % 3
        v = [round(rnd.gauss(0, 1), 1), round(rnd.gauss(0, 3), 1)]
        rows.append((i, g, v))
    if dup:
        rows.append((n, 0, list(rows[0][2])))  # exact duplicate point
    return rows


@pytest.mark.parametrize("how", SEARCHES)
def test_knn_exact_vs_brute_force(spark, how):
    rows = _pts(spark, 300)
    df = spark.createDataFrame(rows, "id int, g int, vec array<double>")
    got = knn_join(df, df, 5, "id", "id", "vec", by=["g"], exclude_self=True, **how).collect()
    res = {}
    for r in got:
        res.setdefault(r.id, []).append((r.rank, r.nn_id, r.dist))
    for i, g, v in rows:
        cand = sorted((_d(v, w), j) for j, gg, w in rows if gg == g and j != i)[:5]
        mine = sorted(res[i])
        assert [j for _, j, _ in mine] == [j for _, j in cand]
        assert all(abs(d - dd) < 1e-12 for (_, _, d), (dd, _) in zip(mine, cand))


@pytest.mark.parametrize("how", SEARCHES)
def test_knn_unblocked_small_group(spark, how):
    rows = [(0, 0, [0.0, 0.0]), (1, 0, [1.0, 0.0]), (2, 0, [5.0, 5.0])]
    df = spark.createDataFrame(rows, "id int, g int, vec array<double>")
    got = knn_join(df, df, 5, "id", "id", "vec", exclude_self=True, **how).collect()
    assert sorted((r.id, r.nn_id) for r in got) == [(0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1)]


def test_smote_balances_and_interpolates(spark):
    rnd = random.Random(3)
    rows = [(i, 0 if i < 60 else (1 if i < 80 else 2), [rnd.random(), rnd.random()]) for i in range(90)]
    df = spark.createDataFrame(rows, "id int, label int, vec array<double>")
    syn = smote(df, "id", "label", "vec", k=5, seed=42)
    after = df.select("label").unionByName(syn.select("label")).groupBy("label").count().collect()
    assert sorted(r["count"] for r in after) == [60, 60, 60]
    pts = {i: v for i, _, v in rows}
    for r in syn.collect():
        a, b = pts[r.id], pts[r.nn_id]
        exp = [x + r.gap * (y - x) for x, y in zip(a, b)]
        assert all(abs(p - q) < 1e-12 for p, q in zip(r.vec, exp)) and 0 <= r.gap < 1
        assert [x for x in rows if x[0] == r.nn_id][0][1] == r.label


def test_balance_and_weights(spark):
    df = spark.createDataFrame([(i, int(i < 30)) for i in range(100)], "id int, y int")
    w = {r.y: r.weight for r in class_weights(df, "y").collect()}
    assert abs(w[1] - 100 / (2 * 30)) < 1e-12 and abs(w[0] - 100 / (2 * 70)) < 1e-12
    s = {r.y: r.share for r in class_balance(df, "y").collect()}
    assert abs(s[1] - 0.3) < 1e-12


@pytest.mark.parametrize("how", SEARCHES)
def test_knn_exact_on_tied_integer_grid(spark, how):
    rnd = random.Random(9)
    rows = [(i, 0, [float(rnd.randint(1, 31)), float(rnd.randint(1, 12)), float(rnd.randint(1995, 2001)),
                    round(rnd.random(), 2)]) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, g int, vec array<double>")
    got = knn_join(df, df, 5, "id", "id", "vec", exclude_self=True, **how).collect()
    res = {}
    for r in got:
        res.setdefault(r.id, []).append((r.rank, r.nn_id))
    for i, _, v in rows:
        cand = sorted((_d(v, w), j) for j, _, w in rows if j != i)[:5]
        assert [j for _, j in sorted(res[i])] == [j for _, j in cand]


@pytest.mark.parametrize("how", SEARCHES)
def test_knn_exact_with_hot_copy_group(spark, how):
    rnd = random.Random(17)
    rows = [(i, 0, [1.0, 2.0, 3.0]) for i in range(300)]                       # one vector, 300 copies
    rows += [(300 + i, 0, [rnd.random() * 4, rnd.random() * 4, rnd.random() * 4]) for i in range(100)]
    rows += [(400 + i, 0, [1.0, 2.0, 3.5]) for i in range(20)]                  # a second copy group nearby
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "id int, g int, vec array<double>")
    got = knn_join(df, df, 5, "id", "id", "vec", by=["g"], exclude_self=True, **how).collect()
    res = {}
    for r in got:
        res.setdefault(r.id, []).append((r.rank, r.nn_id))
    assert len(res) == len(rows)
    for i, _, v in rows:
        cand = sorted((_d(v, w), j) for j, _, w in rows if j != i)[:5]
        assert [j for _, j in sorted(res[i])] == [j for _, j in cand], i


def test_smote_chunked_generation_for_tiny_class(spark):
    rnd = random.Random(8)
    rows = [(i, 0, [rnd.random(), rnd.random()]) for i in range(400)] + [(400 + i, 1, [5.0 + i, 5.0]) for i in range(3)]
    df = spark.createDataFrame(rows, "id int, label int, vec array<double>")
    syn = smote(df, "id", "label", "vec", k=5, seed=1, chunk=10)
    got = syn.collect()
    assert len(got) == 397 and len({(r.id, r.s) for r in got}) == 397
    pts = {i: v for i, _, v in rows}
    for r in got:
        assert r.label == 1 and r.nn_id in (400, 401, 402) and r.nn_id != r.id
        exp = [x + r.gap * (y - x) for x, y in zip(pts[r.id], pts[r.nn_id])]
        assert all(abs(a - b) < 1e-12 for a, b in zip(r.vec, exp))


def test_knn_of_nothing_and_of_text_ids(spark):
    df = spark.createDataFrame([("a", 0, [0.0]), ("b", 0, [1.0]), ("c", None, [0.0]), ("d", 0, None)], "id string, g int, vec array<double>")
    got = knn_join(df, df, 2, "id", "id", "vec", by=["g"], exclude_self=True).collect()
    assert sorted((r.id, r.nn_id, r["rank"], r.dist) for r in got) == [("a", "b", 1, 1.0), ("b", "a", 1, 1.0)]
    none = df.where("id = 'z'")
    assert knn_join(none, none, 2, "id", "id", "vec", by=["g"]).count() == 0 and knn_join(none, none, 2, "id", "id", "vec").count() == 0
    with pytest.raises(ValueError, match="method"):
        knn_join(df, df, 2, "id", "id", "vec", method="other")


def test_nearest_of_a_block_are_those_by_plain_distances():
    """Equal to all distances summed left to right and sorted: ties, great offsets and components that aren't finite too."""
    import numpy as np
    rng = np.random.default_rng(3)
    odd = rng.normal(size=(40, 3))
    odd[3, 1], odd[7, 2] = np.nan, np.inf
    cases = [(rng.normal(size=(60, 16)), rng.normal(size=(90, 16))), (rng.integers(0, 3, (50, 3)) * 1.0, rng.integers(0, 3, (80, 3)) * 1.0),
             (1e7 + rng.normal(size=(30, 5)), 1e7 + rng.normal(size=(40, 5))), (odd, odd), (rng.normal(size=(9, 2)), rng.normal(size=(2, 2)))]
    for q, p in cases:
        with np.errstate(all="ignore"):
            d2 = np.zeros((len(q), len(p)))
            for i in range(q.shape[1]):
                d2 += (q[:, i][:, None] - p[:, i][None, :]) ** 2
            want = np.argsort(np.sqrt(d2), axis=1, kind="stable")[:, :4]
            row, hit, dist = NB._nearest(q, p, 4)
        assert row.tolist() == np.repeat(np.arange(len(q)), want.shape[1]).tolist() and hit.tolist() == want.ravel().tolist()
        assert np.array_equal(dist, np.sqrt(np.take_along_axis(d2, want, axis=1)).ravel(), equal_nan=True)


def test_blocks_of_a_long_side_get_larger(spark, monkeypatch):
    rnd = random.Random(2)
    e = spark.createDataFrame([(i, [rnd.random() for _ in range(4)]) for i in range(300)], "id int, vec array<double>")
    small = {(r.id, r["rank"], r.nn_id) for r in NB.knn_join(e, e, 3, "id", "id", exclude_self=True).collect()}
    monkeypatch.setattr(NB, "WIDE", 2)
    cut = {(r.id, r["rank"], r.nn_id) for r in NB.knn_join(e, e, 3, "id", "id", exclude_self=True, block=10).collect()}
    assert small == cut and len(cut) == 900
