import datetime as dt
import random

import pandas as pd
from dealcast.operators import naive as N
from dealcast.operators import rollup as A
from dealcast.operators import windows as W
from dealcast.operators.splits import split_tail
from dealcast.sources.posts import POSTS_SCHEMA


def _posts(spark, rows):
    return spark.createDataFrame(rows, POSTS_SCHEMA)


def test_rollup_and_fill(spark):
    rows = [("a", "s1", "20% Off + Free Gift", "6/20/2020", None, 7, 3),
            ("a", "s1", "20% Off", "6/20/2020", 204, 273, 125),
            ("a", "s2", "Free Gift", "2020-06-23", 7, 20, 9),
            ("a", "s2", "junk", "n/a", 1, 1, 1),
            ("b", "t", "BOGO", "2020-01-01", None, None, None)]
    parsed = A.parse_posts(_posts(spark, rows))
    daily = A.daily_rollup(parsed, keep_lists=True)
    d = {(r.brand, r.posted_date): r for r in daily.collect()}
    r = d[("a", dt.date(2020, 6, 20))]
    assert (r.n_posts, r.n_stores, r.n_texts, r.comments_count, r.bookmarks_count) == (2, 1, 2, 204, 280)
    assert r.discount_off == 0.2 and r.gwp and r.stores == ["s1"]
    assert d[("b", dt.date(2020, 1, 1))].comments_count == 0 and d[("b", dt.date(2020, 1, 1))].discount_off == 0.5
    assert len(d) == 3  # the unparseable date is dropped
    filled = A.fill_calendar(A.daily_rollup(parsed)).orderBy("brand", "posted_date").collect()
    a = [x for x in filled if x.brand == "a"]
    assert [x.posted_date.day for x in a] == [20, 21, 22, 23]
    assert [x.rn for x in a] == [1, 2, 3, 4] and all(x.n == 4 for x in a)
    assert a[1].n_posts == 0 and a[1].discount_off == 0.0 and a[1].gwp is False
    assert a[3].gwp and a[3].discount_off == 0.0


def _series(spark, n, seed=1):
    rnd = random.Random(seed)
    start = dt.date(2018, 1, 1)
    vals = [rnd.choice([0.0, 0.0, 0.1, 0.2, 0.25, 0.5]) for _ in range(n)]
    rows = [("x", start + dt.timedelta(days=i), v, rnd.random() < 0.3, i + 1, n) for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "brand string, posted_date date, discount_off double, gwp boolean, rn int, n int"), vals


def test_rolling_matches_pandas(spark):
    df, vals = _series(spark, 150)
    out = W.add_rolling(W.add_lags(df)).orderBy("posted_date").toPandas()
    s = pd.Series(vals)
    for k in (1, 7, 14, 30):
        sh = s.shift(k).rolling(k)
        for stat, ref in (("mean", sh.mean()), ("max", sh.max()), ("sum", sh.sum())):
            got = out[f"{stat}_{k}"]
            for i in range(150):
                if pd.isna(ref[i]):
                    assert pd.isna(got[i]), (stat, k, i)
                else:
                    assert abs(got[i] - ref[i]) < 1e-9, (stat, k, i)
    for k in (1, 7, 14, 30, 365):
        ref = s.shift(k)
        assert all((pd.isna(a) and pd.isna(b)) or a == b for a, b in zip(out[f"t_{k}"], ref))


def test_naive_forecasts_match_week_loop(spark):
    n = 900
    df, vals = _series(spark, n, seed=3)
    preds = N.naive_forecasts(df).toPandas()
    train, test = vals[6:-365], vals[-365:-1]
    # explicit walk-forward over weeks with the history growing by the real week
    assert len(train) % 7 == (n - 371) % 7
    weeks_train = [train[len(train) % 7 + 7 * i: len(train) % 7 + 7 * i + 7] for i in range(len(train) // 7)]
    history = list(weeks_train)
    expect = {"daily": [], "weekly": [], "week_oya": []}
    for w in range(len(test) // 7):
        expect["daily"] += [history[-1][-1]] * 7
        expect["weekly"] += list(history[-1])
        expect["week_oya"] += list(history[-52])
        history.append(test[7 * w: 7 * w + 7])
    for m, exp in expect.items():
        got = preds[preds.model == m].sort_values("day_ahead").yhat.tolist()
        assert got == exp, m
    assert sorted(preds.day_ahead.unique().tolist()) == list(range(364))


def test_split_tail_positions(spark):
    df, _ = _series(spark, 400)
    c = {r.split: r["count"] for r in split_tail(df).groupBy("split").count().collect()}
    assert c == {"skip": 6, "train": 400 - 371, "test": 364, "last": 1}
