"""Lag and rolling features over the gap-free panel.

Every window here is ``partitionBy(brand).orderBy(posted_date)``: all features
share ONE exchange and ONE sort. A partition is one brand's calendar, bounded by
the number of days in its span, not by the number of posts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LAGS = (1, 7, 14, 30, 365)
ROLL_WIDTHS = (1, 7, 14, 30)
ROLL_STATS = ("mean", "max", "sum")


def series_window(by: str = "brand", order: str = "posted_date"):
    return Window.partitionBy(by).orderBy(order)


def _pos(df: DataFrame):
    if "rn" in df.columns:
        return F.col("rn")
    return F.row_number().over(series_window())


def lag_columns(y: str = "discount_off", lags=LAGS, prefix: str = "t_") -> dict:
    w = series_window()
    return {f"{prefix}{k}": F.lag(y, k).over(w) for k in lags}


def rolling_columns(df: DataFrame, y: str = "discount_off", widths=ROLL_WIDTHS, stats=ROLL_STATS,
                    digits: int | None = None) -> dict:
    """Rolling stat of width k over the series shifted by k.

    Frame ``rowsBetween(-(2k-1), -k)``; null until the frame holds k rows
    (position >= 2k), as a full-window rolling statistic would be. ``digits`` rounds
    means and sums, for bins and ranks that must not depend on summation order.
    """
    w = series_window()
    pos = _pos(df)
    fn = {"mean": F.avg, "max": F.max, "sum": F.sum, "min": F.min}
    out = {}
    for k in widths:
        frame = w.rowsBetween(-(2 * k - 1), -k)
        for s in stats:
            name = f"{s}_{k}"
            if k == 1 and s in ("mean", "max", "sum", "min"):
                # width 1 over lag 1 is the lag itself (Q13): no extra frame
                out[name] = F.lag(y, 1).over(w)
            elif s in ("mean", "sum") and digits is not None:
                out[name] = F.when(pos >= 2 * k, F.round(fn[s](y).over(frame), digits))
            else:
                out[name] = F.when(pos >= 2 * k, fn[s](y).over(frame))
    return out


def add_lags(panel: DataFrame, y: str = "discount_off", lags=LAGS, prefix: str = "t_") -> DataFrame:
    return panel.withColumns(lag_columns(y, lags, prefix))


def add_rolling(panel: DataFrame, y: str = "discount_off", widths=ROLL_WIDTHS, stats=ROLL_STATS) -> DataFrame:
    return panel.withColumns(rolling_columns(panel, y, widths, stats))


def add_week_slots(panel: DataFrame, tail: int = 365) -> DataFrame:
    """Week number and day slot anchored at the test start.

    k = rn - (n - tail) - 1: 0 on the first test day, negative in train.
    """
    k = F.col("rn") - (F.col("n") - tail) - 1
    return panel.withColumns({"week": F.floor(k / 7).cast("int"), "slot": F.pmod(k, F.lit(7)).cast("int")})
