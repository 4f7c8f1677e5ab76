import calendar
import datetime as dt

from dealcast.functions.calendar import nth_weekday
from dealcast.functions.text import ad_flag, age_to_date, discount_off, gwp_flag, parse_posted_date, pct_off
from dealcast.operators.holidays import holiday_table, nearest_holiday_by_date, PARENT_RULES, FEDERAL_RULES


def test_parse_posted_date(spark):
    rows = [("6/20/2020",), ("2020-05-21",), ("n/a",), (None,), ("12/1/2019",), ("2020-13-01",), ("2/30/2020",)]
    df = spark.createDataFrame(rows, "s string").select(parse_posted_date("s").alias("d"))
    got = [r.d for r in df.collect()]
    assert got == [dt.date(2020, 6, 20), dt.date(2020, 5, 21), None, None, dt.date(2019, 12, 1), None, None]


def test_discount_and_flags(spark):
    texts = ["20% Off + Free Gift", "Up to 25% Off", "BOGO", "Buy one get one free 30%", "Free Gift", None,
             "Receive 6 deluxe samples", "DEALMOON EXCLUSIVE: 20% Off", "Full size", "no deal"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", pct_off("t").alias("p"), discount_off("t").alias("d"), gwp_flag("t").alias("g"),
        gwp_flag("t", ignore_case=True).alias("gi"), ad_flag("t").alias("a"))
    r = {x.t: x for x in df.collect()}
    assert r["20% Off + Free Gift"].d == 0.2 and r["20% Off + Free Gift"].g
    assert r["Up to 25% Off"].d == 0.25 and not r["Up to 25% Off"].g
    assert r["BOGO"].d == 0.5 and r["Buy one get one free 30%"].d == 0.5
    assert r["Free Gift"].d == 0.0 and r["Free Gift"].p is None
    nulls = [x for x in df.collect() if x.t is None][0]
    assert nulls.d == 0.0 and nulls.g is False and nulls.a is False
    assert not r["Receive 6 deluxe samples"].g and r["Receive 6 deluxe samples"].gi
    assert r["DEALMOON EXCLUSIVE: 20% Off"].a and r["DEALMOON EXCLUSIVE: 20% Off"].d == 0.2
    assert r["Full size"].g and not r["no deal"].g


def test_age_to_date(spark):
    df = spark.createDataFrame([("3 days ago",), ("5 mins ago",), ("2 hrs ago",), ("whenever",)], "t string")
    got = [r.d for r in df.select(age_to_date("t", "2020-06-21").alias("d")).collect()]
    assert got == [dt.date(2020, 6, 18), dt.date(2020, 6, 21), dt.date(2020, 6, 21), None]


def test_nth_weekday_matches_python_calendar(spark):
    years = list(range(2010, 2026))
    df = spark.createDataFrame([(y,) for y in years], "y int").select(
        "y", nth_weekday("y", 5, 6, 2).alias("mothers"), nth_weekday("y", 6, 6, 3).alias("fathers"),
        nth_weekday("y", 5, 0, -1).alias("memorial"), nth_weekday("y", 11, 3, 4).alias("thanks"))
    for r in df.collect():
        sundays5 = [d for w in calendar.Calendar().monthdatescalendar(r.y, 5) for d in w if d.month == 5 and d.weekday() == 6]
        sundays6 = [d for w in calendar.Calendar().monthdatescalendar(r.y, 6) for d in w if d.month == 6 and d.weekday() == 6]
        mondays5 = [d for w in calendar.Calendar().monthdatescalendar(r.y, 5) for d in w if d.month == 5 and d.weekday() == 0]
        thu11 = [d for w in calendar.Calendar().monthdatescalendar(r.y, 11) for d in w if d.month == 11 and d.weekday() == 3]
        assert r.mothers == sundays5[1] and r.fathers == sundays6[2] and r.memorial == mondays5[-1] and r.thanks == thu11[3]


def test_nearest_holiday_brute_force(spark):
    h = holiday_table(spark, 2015, 2021).collect()
    hol = sorted(((r.kind, r.holiday_date, r.holiday_name) for r in h))
    years = spark.createDataFrame([(y,) for y in range(2015, 2022)], "year int")
    near = {r.posted_date: (r.near_name, r.near_dist) for r in nearest_holiday_by_date(years, 30).collect()}
    d = dt.date(2016, 1, 1)
    while d <= dt.date(2020, 12, 31):
        best = min(hol, key=lambda x: (abs((x[1] - d).days), x[0], x[1], x[2]))
        dist = abs((best[1] - d).days)
        if dist < 30:
            assert near[d] == (best[2], dist), d
        else:
            assert d not in near
        d += dt.timedelta(days=1)
    assert len(FEDERAL_RULES) + len(PARENT_RULES) == 13
