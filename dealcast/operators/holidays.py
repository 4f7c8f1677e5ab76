"""Holiday calendar (F10) and nearest-holiday windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealcast.functions.calendar import nth_weekday

# ---------------------------------------------------------------------------
# US federal holiday rules and names (as listed by the common
# Python holiday calendar for the US), then the two parents' days with the
# names the reference gives them. Rule kinds: ("fixed", month, day) or
# ("nth", month, weekday Mon=0, n; n = -1 means last). Last item: first year.
FEDERAL_RULES = [
    ("New Year's Day", ("fixed", 1, 1), 1871),
    ("Martin Luther King Jr. Day", ("nth", 1, 0, 3), 1986),
    ("Washington's Birthday", ("nth", 2, 0, 3), 1971),
    ("Memorial Day", ("nth", 5, 0, -1), 1971),
    ("Juneteenth National Independence Day", ("fixed", 6, 19), 2021),
    ("Independence Day", ("fixed", 7, 4), 1871),
    ("Labor Day", ("nth", 9, 0, 1), 1894),
    ("Columbus Day", ("nth", 10, 0, 2), 1971),
    ("Veterans Day", ("fixed", 11, 11), 1978),
    ("Thanksgiving", ("nth", 11, 3, 4), 1871),
    ("Christmas Day", ("fixed", 12, 25), 1871),
]
# Second Sunday of May (the reference took the third, Q3) and third Sunday of June.
PARENT_RULES = [
    ("Mother's day", ("nth", 5, 6, 2), 1914),
    ("Fathers's day", ("nth", 6, 6, 3), 1972),
]
NORMAL = "Normal"
EVENT_WIDTHS = {"event_1day": 1, "event_7days": 7, "event_14days": 14, "event_1month": 30}
# ---------------------------------------------------------------------------


def _rule_date(year: Column, rule) -> Column:
    if rule[0] == "fixed":
        return F.make_date(year, F.lit(rule[1]), F.lit(rule[2]))
    _, month, wd, n = rule
    return nth_weekday(year, month, wd, n)


def _observed(d: Column) -> Column:
    # Saturday -> Friday before, Sunday -> Monday after.
    wd = F.weekday(d)
    return F.when(wd == 5, F.date_sub(d, 1)).when(wd == 6, F.date_add(d, 1))


def holidays_for_years(years: DataFrame, year_col: str = "year", observed: bool = False) -> DataFrame:
    """Holiday rows for every year row: (holiday_date, holiday_name, kind).

    ``kind`` 0 = federal, 1 = parents' day. Built by exploding an array of
    rule structs per year, so the table is (years x rules) without a join.
    ``observed`` adds the weekend-shifted federal days as extra rows (off by default).
    """
    y = F.col(year_col)
    items = []
    for kind, rules in ((0, FEDERAL_RULES), (1, PARENT_RULES)):
        for name, rule, since in rules:
            d = _rule_date(y, rule)
            items.append(F.struct(F.when(y >= since, d).alias("holiday_date"),
                                   F.lit(name).alias("holiday_name"), F.lit(kind).alias("kind")))
            if observed and kind == 0 and rule[0] == "fixed":
                items.append(F.struct(F.when(y >= since, _observed(d)).alias("holiday_date"),
                                      F.lit(name + " (Observed)").alias("holiday_name"), F.lit(kind).alias("kind")))
    out = years.select(F.inline(F.array(*items)))
    return out.where(F.col("holiday_date").isNotNull())


def holiday_table(spark: SparkSession, first_year: int, last_year: int, observed: bool = False) -> DataFrame:
    """Holiday table for an explicit year range.

    List order (used for ties) is (kind, holiday_date, holiday_name): federal
    days by date, then the parents' days.
    """
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("year"))
    return holidays_for_years(years, observed=observed).select("holiday_date", "holiday_name", "kind")


def nearest_holiday_by_date(years: DataFrame, max_width: int = 30, observed: bool = False) -> DataFrame:
    """For every date within ``max_width - 1`` days of a holiday: the nearest one.

    Each holiday is exploded to the dates around it (2 * max_width - 1 rows), then
    one row per date is kept: smallest distance, ties to the first in list order
    (federal before parents' days, earlier date first). Size is bounded by the
    number of calendar days in the year span, independent of data volume.
    """
    h = holidays_for_years(years, observed=observed)
    r = max_width - 1
    near = h.select(
        "holiday_name", "kind", "holiday_date",
        F.explode(F.sequence(F.lit(-r), F.lit(r))).alias("off"))
    near = near.select(
        F.date_add("holiday_date", F.col("off")).alias("posted_date"),
        F.abs("off").alias("dist"), "kind", "holiday_date", "holiday_name")
    best = F.min(F.struct("dist", "kind", "holiday_date", "holiday_name")).alias("b")
    return (near.groupBy("posted_date").agg(best)
            .select("posted_date", F.col("b.holiday_name").alias("near_name"), F.col("b.dist").alias("near_dist")))


def nearest_holiday(date: Column, observed: bool = False) -> Column:
    """Struct (dist, kind, holiday_date, holiday_name) of the holiday nearest to a date.

    The rules of the date's own year and of the two beside it hold every holiday
    that can be nearest; the smallest struct has the smallest distance, ties go
    to the first holiday in list order.
    """
    items = []
    for shift in (-1, 0, 1):
        year = F.year(date) + shift
        for kind, rules in ((0, FEDERAL_RULES), (1, PARENT_RULES)):
            for name, rule, since in rules:
                days = [(name, _rule_date(year, rule))]
                if observed and kind == 0 and rule[0] == "fixed":
                    days.append((name + " (Observed)", _observed(days[0][1])))
                for label, d in days:
                    items.append(F.when((year >= since) & d.isNotNull(), F.struct(
                        F.abs(F.date_diff(d, date)).alias("dist"), F.lit(kind).alias("kind"),
                        d.alias("holiday_date"), F.lit(label).alias("holiday_name"))))
    return F.array_min(F.array(*items))


def add_holiday_windows(panel: DataFrame, widths: dict = EVENT_WIDTHS, observed: bool = False,
                        date_col: str = "posted_date") -> DataFrame:
    """Name of the nearest holiday when it is closer than each width, else 'Normal' (J2).

    Distance is symmetric and strict (< width); ties go to the first holiday in
    list order. Computed in each row from the date rules: no calendar table, no
    join and no bound on the years.
    """
    j = panel.withColumn("_near", nearest_holiday(F.col(date_col), observed))
    ev = {name: F.when(F.col("_near.dist") < w, F.col("_near.holiday_name")).otherwise(F.lit(NORMAL))
          for name, w in widths.items()}
    return j.withColumns(ev).drop("_near")
