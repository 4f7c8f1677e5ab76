"""Text rules that turn a free-text deal post into labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the reference's rules for the same labels.
# Matching is plain case-sensitive substring containment, as in the reference.
GWP_WORDS = ["Gift", "Gifts", "Samples", "Sample", "GWP", "Travel", "Full"]
BOGO_WORDS = ["BOGO", "Buy one get one free"]
AD_WORDS = ["Dealmoon", "DEALMOON"]
BOGO_VALUE = 0.5
PERCENT_PATTERN = r"([0-9]+)%"
DATE_FORMATS = ["M/d/yyyy", "yyyy-MM-dd"]
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Fast paths for the two default formats: a value with the exact shape of a
# format is rewritten to ISO text and cast (no formatter, no exception per
# failed parse); anything else falls back to trying every format in order.
_FAST = {
    "M/d/yyyy": (r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})$", "$3-$1-$2"),
    "yyyy-MM-dd": (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", None),
}


def parse_posted_date(c, formats: list[str] = DATE_FORMATS) -> Column:
    """Lenient date parse: the first format that parses wins, failure -> null (F1).

    ``try_*`` functions keep ANSI mode from raising on junk such as ``n/a``.
    Shapes of different formats never overlap, so the fast paths keep the
    first-format-wins rule.
    """
    c = _c(c)
    generic = F.coalesce(*[F.try_to_date(c, f) for f in formats])
    out = None
    for f in formats:
        if f not in _FAST:
            continue
        shape, iso = _FAST[f]
        val = (F.regexp_replace(c, shape, iso) if iso else c).try_cast("date")
        cond = c.rlike(shape)
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return generic if out is None else out.otherwise(generic)


def contains_any(c, words: list[str], ignore_case: bool = False) -> Column:
    """True when the text contains any word; null text -> False."""
    c = _c(c)
    if ignore_case:
        c = F.lower(c)
        words = [w.lower() for w in words]
    return F.coalesce(reduce(lambda a, b: a | b, [c.contains(w) for w in words]), F.lit(False))


def ad_flag(c, words: list[str] = AD_WORDS) -> Column:
    """Post is a site advertisement (P5). Ads are flagged, not dropped by default (Q2)."""
    return contains_any(c, words)


def pct_off(c) -> Column:
    """First ``<digits>%`` as a fraction; no match -> null (F3). "Up to 20%" counts as 0.20."""
    # nullif, not try_cast: a failing string->double cast costs an exception per row
    digits = F.nullif(F.regexp_extract(_c(c), PERCENT_PATTERN, 1), F.lit(""))
    return digits.cast("double") / 100.0


def discount_off(c, bogo_words: list[str] = BOGO_WORDS) -> Column:
    """Percent fraction, BOGO texts forced to 0.5 (F4 overrides F3), none -> 0.0."""
    return (F.when(contains_any(c, bogo_words), F.lit(BOGO_VALUE))
             .otherwise(F.coalesce(pct_off(c), F.lit(0.0))))


def gwp_flag(c, words: list[str] = GWP_WORDS, ignore_case: bool = False) -> Column:
    """Gift-with-purchase flag (F5); case sensitive by default (Q9)."""
    return contains_any(c, words, ignore_case)


def age_to_date(c, as_of) -> Column:
    """Relative age text such as "3 days ago" -> date (F2).

    Sub-day units mean today; weeks count seven days, months and years are
    calendar ones; any other number is a day count; text without a number, or
    with one too large for a date, -> null (Q17).
    """
    c = F.lower(_c(c))
    as_of = F.lit(as_of).cast("date") if not isinstance(as_of, Column) else as_of.cast("date")
    n = F.nullif(F.regexp_extract(c, r"([0-9]+)", 1), F.lit("")).try_cast("int")
    n = F.when(n <= 3_000_000, n)
    subday = c.rlike(r"\b(sec|secs|second|seconds|min|mins|minute|minutes|hr|hrs|hour|hours)\b")
    months = F.when(c.rlike(r"\b(month|months)\b"), n).when(c.rlike(r"\b(year|years)\b"), 12 * n)
    days = F.when(c.rlike(r"\b(week|weeks)\b"), 7 * n).otherwise(n)
    return (F.when(subday, as_of)
             .when(months.isNotNull(), F.when(months <= 100_000, F.add_months(as_of, -months)))
             .when(days.isNotNull(), F.date_sub(as_of, days)))
