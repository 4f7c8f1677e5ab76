"""Calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the reference's weekend is Friday + Saturday (Q6).
# Spark ``weekday``: Monday = 0 ... Sunday = 6.
WEEKEND_DAYS = (4, 5)
_DOW_ABBR = ["MO", "TU", "WE", "TH", "FR", "SA", "SU"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def weekday_name(d) -> Column:
    """English day name, e.g. ``Friday``."""
    return F.date_format(_c(d), "EEEE")


def weekend_flag(d, days=WEEKEND_DAYS) -> Column:
    return F.weekday(_c(d)).isin(list(days))


def nth_weekday(year, month: int, weekday: int, n: int) -> Column:
    """Date of the ``n``-th given weekday (0 = Monday) of a month; ``n = -1`` is the last one."""
    y = _c(year)
    first = F.make_date(y, F.lit(month), F.lit(1))
    if n == -1:
        last = F.last_day(first)
        back = F.pmod(F.weekday(last) - F.lit(weekday), F.lit(7))
        return F.date_sub(last, back)
    shift = F.pmod(F.lit(weekday) - F.weekday(first), F.lit(7)) + F.lit(7 * (n - 1))
    return F.date_add(first, shift)
