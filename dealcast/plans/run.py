"""End-to-end run: posts -> panel -> forecasts and scores -> gift-day horizon -> advice.

    python -m dealcast.plans.run --posts 'data/posts/*.csv' --out out/
    python -m dealcast.plans.run --tables /root/testdata/sf0.01 --out out/

Writes (parquet unless noted):
  panel/            gap-free brand x day panel, partitioned by brand
  naive_forecasts/  walk-forward forecasts of the test year
  naive_scores/     RMSE per brand, model and day slot
  discount_forecast/  learned (forest) discount forecast of the test year
  gwp_forecast/     learned gift-day forecast on the scoring frame
  advice/           one advice row per brand (also advice_csv/ with a header)
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from dealcast.operators import metrics as E
from dealcast.operators import naive as N
from dealcast.operators.recommend import recommend
from dealcast.plans.classify import gwp_horizon
from dealcast.plans.clean import build_panel
from dealcast.plans.forecast import learned_discount_forecast
from dealcast.session import cut_lineage, get_spark
from dealcast.sources.panel import read_panel, write_panel
from dealcast.sources.posts import deals_view, read_posts


def run(spark, out: str, posts=None, tables: str | None = None, candidates: list | None = None, search: dict | None = None) -> None:
    posts = posts if posts is not None else deals_view(spark, tables)
    write_panel(build_panel(posts), f"{out}/panel")
    panel = read_panel(spark, f"{out}/panel")            # later steps start from the written table
    preds = N.naive_forecasts(panel)
    preds.write.mode("overwrite").parquet(f"{out}/naive_forecasts")
    E.forecast_scores(spark.read.parquet(f"{out}/naive_forecasts")).write.mode("overwrite").parquet(f"{out}/naive_scores")
    learned_discount_forecast(panel, candidates=candidates).write.mode("overwrite").parquet(f"{out}/discount_forecast")
    gwp_horizon(panel, search=search).write.mode("overwrite").parquet(f"{out}/gwp_forecast")
    disc = spark.read.parquet(f"{out}/discount_forecast")
    gift = spark.read.parquet(f"{out}/gwp_forecast")
    j = disc.join(gift, ["brand", "day_ahead"], "left").withColumn("pred_gwp", F.coalesce("pred_gwp", F.lit(False)))
    advice = cut_lineage(recommend(j))
    advice.write.mode("overwrite").parquet(f"{out}/advice")
    advice.write.mode("overwrite").option("header", True).csv(f"{out}/advice_csv")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--posts", help="post CSV file(s) or glob with the scraper header")
    src.add_argument("--tables", help="directory of the shared parquet tables (posts view over them)")
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    a =ap.parse_args(argv)
    spark = get_spark(app="dealcast-run")
    posts = read_posts(spark, a.posts) if a.posts else None
    run(spark, a.out, posts=posts, tables=a.tables)


if __name__ == "__main__":
    main()
