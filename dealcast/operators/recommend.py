"""Per-brand "when to buy" advice from horizon predictions.

Input: (brand, day_ahead, pred_discount, pred_gwp). Every answer is one
aggregation per brand (min_by / conditional min), partial-aggregated map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealcast.functions.format import fixed

# ---------------------------------------------------------------------------
# The advice texts of the reference app (F13), with its spelling.
MSG_NONE_TODAY = "No discount today :("
MSG_GWP_TODAY = "You have gift with purchase today!"
MSG_BOTH_TODAY = "Hurry up! You have gift with purchase and discount today!"
MSG_BEST_DAY = "The largest discount this year will happen in %s days!"
MSG_BEST_PCT = "You will get %.0f %% Off, refill your skincare!"
MSG_NEXT = "The nearst discount is going to be in %s days with %.0f %% OFF!"
MSG_NO_RECORD = "This brand does not have discount record!"
MSG_GWP_ONLY = "Refill it when there is a gift with purchse promotion!"
MSG_NEXT_GWP = "The nearest GWP will happen in %s days"
# Added (Q20): a discount today without a gift had no message.
MSG_PCT_TODAY = "You have a discount today!"
# ---------------------------------------------------------------------------


def horizon(preds: DataFrame, wait_days: int) -> DataFrame:
    """Forecast rows of the first ``wait_days - 1`` days (R5), as the app's slider plots them."""
    return preds.where(F.col("day_ahead") < wait_days - 1)


def advice_facts(preds: DataFrame) -> DataFrame:
    """R1-R4, R6 in one aggregation per brand.

    best_day: first day of the maximum discount (ties -> earliest);
    next_discount_day / next_gwp_day: first day with a discount / gift (null if none);
    discount_today / gwp_today: day 0 flags; has_discount_record: any non-zero discount.
    """
    disc = F.col("pred_discount")
    gift = F.col("pred_gwp").cast("boolean")
    day = F.col("day_ahead")
    g = preds.groupBy("brand").agg(
        F.max(disc).alias("best_discount"),
        F.min_by(day, F.struct((-disc).alias("k"), day.alias("d"))).alias("best_day"),
        F.min(F.when(disc > 0, day)).alias("next_discount_day"),
        F.min_by(disc, F.when(disc > 0, day)).alias("next_discount"),
        F.min(F.when(gift, day)).alias("next_gwp_day"),
        F.coalesce(F.max(F.when(day == 0, disc > 0)), F.lit(False)).alias("discount_today"),
        F.coalesce(F.max(F.when(day == 0, gift)), F.lit(False)).alias("gwp_today"),
        F.coalesce(F.bool_or(disc != 0), F.lit(False)).alias("has_discount_record"),
    )
    return g


def recommend(preds: DataFrame) -> DataFrame:
    """Full advice row per brand with its message text (R7), always over the whole
    year; the waiting time only cuts the plotted rows (``horizon``)."""
    f = advice_facts(preds)
    pct = lambda c: F.col(c) * 100.0  # noqa: E731  (F12)
    today = (F.when(~F.col("discount_today") & ~F.col("gwp_today"), F.lit(MSG_NONE_TODAY))
              .when(~F.col("discount_today") & F.col("gwp_today"), F.lit(MSG_GWP_TODAY))
              .when(F.col("discount_today") & F.col("gwp_today"), F.lit(MSG_BOTH_TODAY))
              .otherwise(F.lit(MSG_PCT_TODAY)))
    # numbers rendered with Python's rounding (functions.format.fixed), the
    # fixed message texts filled with format_string's %s
    best_pct, next_pct = fixed(pct("best_discount"), 0), fixed(pct("next_discount"), 0)
    with_record = F.concat_ws(
        " ", today,
        F.format_string(MSG_BEST_DAY, F.col("best_day").cast("string")),
        F.format_string(MSG_BEST_PCT.replace("%.0f", "%s"), best_pct),
        F.format_string(MSG_NEXT.replace("%.0f", "%s"), F.col("next_discount_day").cast("string"), next_pct))
    gwp_next = F.when(F.col("next_gwp_day").isNotNull(),
                      F.format_string(MSG_NEXT_GWP, F.col("next_gwp_day").cast("string")))
    without = F.concat_ws(" ", F.lit(MSG_NO_RECORD), F.lit(MSG_GWP_ONLY), gwp_next)
    return f.select(
        "brand", "has_discount_record", "discount_today", "gwp_today", "best_day",
        F.round(pct("best_discount"), 6).alias("best_discount_pct"),
        "next_discount_day", F.round(pct("next_discount"), 6).alias("next_discount_pct"), "next_gwp_day",
        F.when(F.col("has_discount_record"), with_record).otherwise(without).alias("message"))
