"""Property-based checks (hypothesis) of the core building blocks."""

import datetime as dt

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dealcast.functions.text import discount_off, parse_posted_date
from dealcast.operators.ordered import running_sums

SETTINGS = dict(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 5)), min_size=1, max_size=120),
       st.integers(1, 9), st.booleans())
def test_running_sums_equal_cumsum(spark, rows, slices, desc):
    data = [(g, float(i), v) for i, (g, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "g string, x double, v int")
    got = {(r.g, r.x): (r.cum_v, r.tot_v) for r in running_sums(df, ["g"], "x", ["v"], descending=desc,
                                                                 num_slices=slices).collect()}
    for g in {r[0] for r in data}:
        part = sorted([r for r in data if r[0] == g], key=lambda r: r[1], reverse=desc)
        cum = np.cumsum([r[2] for r in part])
        for r, c in zip(part, cum):
            assert got[(g, r[1])] == (c, cum[-1])


@settings(**SETTINGS)
@given(st.lists(st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2030, 12, 31)), min_size=1, max_size=40),
       st.lists(st.booleans(), min_size=40, max_size=40))
def test_parse_both_formats(spark, dates, us):
    texts = [(f"{d.month}/{d.day}/{d.year}" if u else d.isoformat()) for d, u in zip(dates, us)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.d for r in df.select(parse_posted_date("t").alias("d")).collect()]
    assert got == dates


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(0, 99), st.sampled_from(["% Off", "% off sitewide", " percent", "%"]),
                          st.sampled_from(["", " + Free Gift", " BOGO", " Buy one get one free"])), min_size=1, max_size=30))
def test_discount_rule(spark, parts):
    texts = [f"Save {n}{unit}{extra}" for n, unit, extra in parts]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.d for r in df.select(discount_off("t").alias("d")).collect()]
    for (n, unit, extra), d in zip(parts, got):
        if "BOGO" in extra or "Buy one get one free" in extra:
            assert d == 0.5
        elif unit.startswith("%"):
            assert d == n / 100.0
        else:
            assert d == 0.0
