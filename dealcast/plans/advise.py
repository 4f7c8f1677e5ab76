"""Advice plan: learned discount forecast + learned gift-day forecast -> per-brand message."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealcast.operators.recommend import recommend
from dealcast.plans.classify import gwp_horizon
from dealcast.plans.forecast import learned_discount_forecast


def advise(panel: DataFrame, candidates: list | None = None, search: dict | None = None) -> DataFrame:
    """Both horizons are keyed by (brand, day_ahead) (Q18), joined, then advised.

    ``candidates``: regressors that ``learned_discount_forecast`` compares and refits;
    ``search``: arguments of the gift-day search of ``gwp_horizon``.
    """
    disc = learned_discount_forecast(panel, candidates=candidates)
    gift = gwp_horizon(panel, search=search)
    j = disc.join(gift, ["brand", "day_ahead"], "left").withColumn("pred_gwp", F.coalesce("pred_gwp", F.lit(False)))
    return recommend(j)
