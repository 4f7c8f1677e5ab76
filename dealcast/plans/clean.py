"""posts -> gap-free, labelled brand x day panel (the cleaning stage)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from dealcast.operators.holidays import add_holiday_windows
from dealcast.operators.rollup import add_calendar, daily_rollup, fill_calendar, parse_posts


def build_panel(posts: DataFrame, holidays: bool = True, keep_lists: bool = False,
                drop_ads: bool = False, dedup: bool = False, ignore_case_gwp: bool = False,
                distinct_counts: bool = False) -> DataFrame:
    """Parse per post, roll up per day, fill the calendar, add calendar and holiday columns.

    One pass over the posts. Shuffles: one for the day roll-up (after map-side
    partial aggregation) and one of the day rows by brand for the gap fill,
    which the feature windows downstream reuse. The nearest holiday is computed in
    each row (no join).
    """
    parsed = parse_posts(posts, ignore_case_gwp=ignore_case_gwp, drop_ads=drop_ads, dedup=dedup)
    panel = add_calendar(fill_calendar(daily_rollup(parsed, keep_lists=keep_lists, distinct_counts=distinct_counts)))
    if holidays:
        panel = add_holiday_windows(panel)
    return panel
