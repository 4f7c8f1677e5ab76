"""Naive walk-forward forecasters.

The reference re-forecasts week by week and appends the real week to the
history, so each forecast is a fixed row offset into the past on the gap-free
panel: one window pass computes all models for all brands at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealcast.operators.splits import split_tail
from dealcast.operators.windows import add_week_slots, series_window

MODELS = ("daily", "weekly", "week_oya")


def naive_forecasts(panel: DataFrame, y: str = "discount_off", models=MODELS, skip: int = 6,
                    tail: int = 365) -> DataFrame:
    """Test-window forecasts in long form: (brand, model, posted_date, day_ahead, week, slot, y, yhat).

    * daily: last day of the prior week repeated, i.e. ``slot + 1`` rows back (N1)
    * weekly: same slot of the prior week, 7 rows back (N2)
    * week_oya: same slot 52 weeks back, 364 rows back (N3)

    A forecast whose source day lies before the training start (the first ``skip``
    days) has no history and is null.
    """
    w = series_window()
    p = add_week_slots(split_tail(panel, skip, tail), tail)
    rn, slot = F.col("rn"), F.col("slot")
    first_ok = skip + 1
    lagged = {f"_l{k}": F.lag(y, k).over(w) for k in range(1, 8)}
    lagged["_l364"] = F.lag(y, 364).over(w)
    p = p.select("brand", "posted_date", "rn", "n", "split", "week", "slot", F.col(y).alias("y"), *[
        v.alias(k) for k, v in lagged.items()])
    daily_src = F.element_at(F.array(*[F.col(f"_l{k}") for k in range(1, 8)]), slot + 1)
    fc = {
        "daily": F.when(rn - (slot + 1) >= first_ok, daily_src),
        "weekly": F.when(rn - 7 >= first_ok, F.col("_l7")),
        "week_oya": F.when(rn - 364 >= first_ok, F.col("_l364")),
    }
    t = p.where(F.col("split") == "test")
    stack = ", ".join(f"'{m}', `_f_{m}`" for m in models)
    t = t.select("brand", "posted_date", "week", "slot", "rn", "n", "y",
                 *[fc[m].alias(f"_f_{m}") for m in models])
    out = t.selectExpr("brand", "posted_date", "week", "slot", "rn - (n - 364) AS day_ahead", "y",
                       f"stack({len(models)}, {stack}) AS (model, yhat)")
    return out.select("brand", "model", "posted_date", F.col("day_ahead").cast("int").alias("day_ahead"),
                      "week", "slot", "y", "yhat")


def walk_forward(panel: DataFrame, models=MODELS, y: str = "discount_off") -> DataFrame:
    """Driver over the chosen models (N4): one pass, long output."""
    return naive_forecasts(panel, y, models)


def naive_gwp_scores(panel: DataFrame, skip: int = 6, tail: int = 365) -> DataFrame:
    """Naive gift-day classifiers on the test window, long form (brand, model, posted_date, y, score, pred).

    * ``gwp_week_share``: share of gift days in the 7 days before (score in k/7, many ties)
    * ``gwp_week_oya``: gift flag of the same day 52 weeks earlier (0/1 score)

    ``pred`` = score >= 0.5. These are the baselines the classification metrics
    are exercised with; they need only the panel, so every metric is exact.
    """
    w = series_window()
    g = F.col("gwp").cast("double")
    p = split_tail(panel, skip, tail)
    p = p.select("brand", "posted_date", "rn", "split", F.col("gwp").cast("int").alias("y"),
                 F.when(F.col("rn") >= 8, F.avg(g).over(w.rowsBetween(-7, -1))).alias("_share"),
                 F.when(F.col("rn") >= 365, F.lag(g, 364).over(w)).alias("_oya"))
    t = p.where((F.col("split") == "test") & F.col("_share").isNotNull() & F.col("_oya").isNotNull())
    out = t.selectExpr("brand", "posted_date", "y",
                       "stack(2, 'gwp_week_share', _share, 'gwp_week_oya', _oya) AS (model, score)")
    return out.select("brand", "model", "posted_date", "y", "score",
                      (F.col("score") >= 0.5).cast("int").alias("pred"))


def advice_input(panel: DataFrame, skip: int = 6, tail: int = 365) -> DataFrame:
    """Horizon predictions for the advice queries: (brand, day_ahead, pred_discount, pred_gwp).

    The week-one-year-ago forecasts of discount and gift flag over the test window
    (day_ahead 0..363), i.e. what each brand did 52 weeks earlier.
    """
    w = series_window()
    p = add_week_slots(split_tail(panel, skip, tail), tail)
    ok = F.col("rn") - 364 >= skip + 1
    p = p.select("brand", "split", (F.col("rn") - (F.col("n") - 364)).cast("int").alias("day_ahead"),
                 F.when(ok, F.lag("discount_off", 364).over(w)).alias("pred_discount"),
                 F.when(ok, F.lag("gwp", 364).over(w)).alias("pred_gwp"))
    return p.where((F.col("split") == "test") & F.col("pred_discount").isNotNull()).drop("split")
