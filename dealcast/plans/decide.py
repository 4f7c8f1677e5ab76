"""Decision rule that turns forecasts into deal days.

Fitted forecasts are hardly ever exactly zero, so "is there a deal that day" needs a
rule: a brand's days with the highest forecasts are its deal days, as many of them as
its share of deal days in the training part of the calendar says. The others are
days without a deal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def training_share(panel: DataFrame, is_deal: Column, tail: int = 365) -> DataFrame:
    """brand, share: how many of a brand's days before the last ``tail`` are deal days."""
    train = panel.where(F.col("rn") <= F.col("n") - tail)
    return train.groupBy("brand").agg(F.avg(is_deal.cast("double")).alias("share"))


def deal_days(forecast: DataFrame, shares: DataFrame, score: str, out: str) -> DataFrame:
    """``forecast`` (brand, day_ahead, score) with the boolean ``out``.

    Ties go to the earlier day; a brand without a share has no deal days. A window holds
    one brand's forecast days, a year at most.
    """
    brand = Window.partitionBy("brand")
    rank = F.row_number().over(brand.orderBy(F.desc(score), "day_ahead"))
    rows = forecast.withColumns({"_rank": rank, "_days": F.count(F.lit(1)).over(brand)}).join(shares, "brand", "left")
    flag = F.col("_rank") <= F.round(F.coalesce("share", F.lit(0.0)) * F.col("_days"))
    return rows.withColumn(out, flag).drop("_rank", "_days", "share")
