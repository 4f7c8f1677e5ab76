"""Post parsing, day roll-up and gap-free calendar (A1, J1) plus descriptive aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealcast.functions.text import ad_flag, discount_off, gwp_flag, parse_posted_date
from dealcast.functions.calendar import WEEKEND_DAYS, weekday_name, weekend_flag
from dealcast.functions.stats import safe_corr

COUNTERS = ["comments_count", "bookmarks_count", "shares_count"]


def parse_posts(posts: DataFrame, ignore_case_gwp: bool = False, drop_ads: bool = False,
                dedup: bool = False) -> DataFrame:
    """Per-post labels: parsed date, discount fraction, GWP and ad flags.

    Labels are derived per post, before the day roll-up (Q1): a day with several
    texts keeps the best discount and any gift, instead of losing both. Narrow
    (map-only) stage; it fuses into the scan's whole-stage codegen.
    """
    if dedup:
        posts = posts.dropDuplicates()
    out = posts.select(
        "brand", "store", "discount",
        parse_posted_date("posted_date").alias("posted_date"),
        *COUNTERS,
        discount_off("discount").alias("discount_off"),
        gwp_flag("discount", ignore_case=ignore_case_gwp).alias("gwp"),
        ad_flag("discount").alias("is_ad"),
    )
    if drop_ads:
        out = out.where(~F.col("is_ad"))
    return out


def dedup_posts(posts: DataFrame) -> DataFrame:
    """Exact duplicate removal (F14); not applied by default (Q8)."""
    return posts.dropDuplicates()


def daily_rollup(parsed: DataFrame, keep_lists: bool = False, distinct_counts: bool = True) -> DataFrame:
    """One row per (brand, day); posts without a date are dropped (A1).

    Partial aggregation runs map-side, so a brand holding a third of all posts is
    combined per input split before the shuffle on (brand, day). Distinct counts
    are planned by Spark as an extra (brand, day, value) aggregation, which spreads
    a hot day over many tasks. ``keep_lists`` adds the sorted distinct store and
    text arrays of the reference; their size grows with the number of distinct
    values per day, so they are off by default. ``distinct_counts=False`` drops the
    exact distinct store/text counts (they cost an Expand and a second
    aggregation level and nothing downstream of the panel uses them).
    """
    aggs = [F.count(F.lit(1)).alias("n_posts")]
    if distinct_counts:
        aggs += [F.count_distinct("store").alias("n_stores"), F.count_distinct("discount").alias("n_texts")]
    aggs += [
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in COUNTERS],
        F.max("discount_off").alias("discount_off"),
        F.bool_or("gwp").alias("gwp"),
        F.bool_or("is_ad").alias("has_ad"),
    ]
    if keep_lists:
        aggs += [F.array_sort(F.collect_set("store")).alias("stores"),
                 F.array_sort(F.collect_set("discount")).alias("discounts")]
    return (parsed.where(F.col("posted_date").isNotNull())
            .groupBy("brand", "posted_date").agg(*aggs))


def series_bounds(df: DataFrame, date_col: str = "posted_date") -> DataFrame:
    """First/last day and first year per brand (A3)."""
    return (df.where(F.col(date_col).isNotNull()).groupBy("brand")
            .agg(F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"))
            .withColumn("first_year", F.year("first_date")))


def fill_calendar(daily: DataFrame) -> DataFrame:
    """Gap-free calendar per brand: every day from first to last post day.

    One window pass over the day roll-up (partitioned by brand, ordered by day)
    finds each day's successor; ``explode(sequence(day, next_day - 1))`` then
    emits the day itself plus the missing days after it with zero counters,
    0.0 discount and False flags. No spine join and no second pass over the
    posts: the only shuffle is the roll-up's, then one of the (small) day rows
    by brand, which the lag windows downstream reuse. A brand's partition holds
    its calendar days, never its posts.

    ``rn`` (1-based position) and ``n`` (series length) are date arithmetic on
    the gap-free calendar, so positional logic later needs no row_number.
    """
    w = Window.partitionBy("brand").orderBy("posted_date")
    whole = Window.partitionBy("brand")
    measures = [c for c in daily.columns if c not in ("brand", "posted_date")]
    d = daily.select(
        "*",
        F.lead("posted_date").over(w).alias("_next"),
        F.min("posted_date").over(whole).alias("_first"),
        F.max("posted_date").over(whole).alias("_last"))
    days = F.sequence(F.col("posted_date"), F.coalesce(F.date_sub("_next", 1), F.col("posted_date")))
    x = d.select("*", F.explode(days).alias("_day"))
    real = F.col("_day") == F.col("posted_date")
    zero = {"discount_off": F.lit(0.0), "gwp": F.lit(False), "has_ad": F.lit(False)}
    cols = []
    for c in measures:
        if c in ("stores", "discounts"):
            cols.append(F.when(real, F.col(c)).alias(c))
        else:
            z = zero.get(c, F.lit(0).cast(daily.schema[c].dataType))
            cols.append(F.when(real, F.col(c)).otherwise(z).alias(c))
    return x.select(
        "brand", F.col("_day").alias("posted_date"), *cols,
        (F.date_diff("_day", "_first") + 1).alias("rn"),
        (F.date_diff("_last", "_first") + 1).alias("n"))


def add_calendar(panel: DataFrame, date_col: str = "posted_date", weekend_days=WEEKEND_DAYS) -> DataFrame:
    """year, month, day, weekday name and weekend flag."""
    d = F.col(date_col)
    return panel.withColumns({
        "year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d),
        "weekday": weekday_name(d), "weekend_flg": weekend_flag(d, weekend_days),
    })


def add_date_delta(panel: DataFrame) -> DataFrame:
    """Day number since the series start, plus 1 (F9). Equals ``rn`` on a gap-free panel."""
    w = Window.partitionBy("brand")
    return panel.withColumn("date_delta", F.date_diff("posted_date", F.min("posted_date").over(w)) + 1)


def profile_shape(df: DataFrame) -> DataFrame:
    """Row and column count as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def value_counts(df: DataFrame, col: str, by: list[str] | None = None) -> DataFrame:
    """Frequency of each value, most frequent first (A2)."""
    keys = (by or []) + [col]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), *keys)


def seasonality(panel: DataFrame, unit: str = "month", deal_days_only: bool = True) -> DataFrame:
    """Deal-day counts per month or per weekday (A4, A5).

    Counts deal days (discount or gift). ``deal_days_only=False`` counts calendar
    days as the reference's plot did (Q21). Weekdays come Monday first.
    """
    df = panel
    if deal_days_only:
        df = df.where(F.col("gwp") | (F.col("discount_off") != 0))
    if unit == "month":
        return df.groupBy("brand", F.month("posted_date").alias("month")).agg(
            F.count(F.lit(1)).alias("n_days"))
    if unit == "weekday":
        return df.groupBy("brand", F.weekday("posted_date").alias("weekday_no"),
                          weekday_name("posted_date").alias("weekday")).agg(
            F.count(F.lit(1)).alias("n_days"))
    raise ValueError(unit)


def year_over_year(panel: DataFrame) -> DataFrame:
    """Aligned day-of-year index per calendar year (A6): day_idx = days since the first panel day of that year."""
    first_in_year = F.min("posted_date").over(Window.partitionBy("brand", F.year("posted_date")))
    return panel.select("brand", F.year("posted_date").alias("year"), "posted_date",
                        F.date_diff("posted_date", first_in_year).alias("day_idx"), "discount_off")


def corr_matrix(df: DataFrame, cols: list[str], by: list[str] | None = None) -> DataFrame:
    """Pearson r for every column pair in ONE aggregation, long output.

    Booleans are cast to 0/1. Constant columns give null (no variance), like NaN in pandas.
    Each pair is a handful of running moments, all in one partial aggregation.
    """
    num = [F.col(c).cast("double").alias(c) for c in cols]
    base = df.select(*(by or []), *num)
    pairs = [(a, b) for a in cols for b in cols]
    aggs = [safe_corr(a, b).alias(f"r__{i}") for i, (a, b) in enumerate(pairs)]
    wide = base.groupBy(*(by or [])).agg(*aggs)
    stack = ", ".join(f"'{a}', '{b}', `r__{i}`" for i, (a, b) in enumerate(pairs))
    return wide.selectExpr(*(by or []), f"stack({len(pairs)}, {stack}) AS (col_a, col_b, r)")


def deal_type(discount_off_col="discount_off", gwp_col="gwp"):
    d, g = F.col(discount_off_col), F.col(gwp_col)
    return (F.when((d > 0) & g, "both").when(d > 0, "pct_off").when(g, "gwp").otherwise("neither"))


def engagement_by_type(parsed: DataFrame) -> DataFrame:
    """Engagement (counters) of GWP vs percent-off vs other posts."""
    return (parsed.groupBy("brand", deal_type().alias("deal_type"))
            .agg(F.count(F.lit(1)).alias("n_posts"),
                 *[F.avg(c).alias(f"avg_{c}") for c in COUNTERS],
                 *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(f"sum_{c}") for c in COUNTERS]))
