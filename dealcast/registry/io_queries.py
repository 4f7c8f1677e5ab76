"""Registered queries: CSV/parquet round trips, model-run persistence, streaming roll-up.

Files go to a fresh folder under the session's reliable checkpoint directory
(the shared folder a cluster names in ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os
import uuid

from pyspark.ml.regression import DecisionTreeRegressionModel
from pyspark.sql import functions as F

from dealcast import sqltwins as T
from dealcast.operators import models as M
from dealcast.registry.base import register
from dealcast.registry.core import panel, parsed, posts
from dealcast.registry.model_queries import reg_frames
from dealcast.session import ensure_checkpoint_dir
from dealcast.sources.html import extract_deals, listing_page
from dealcast.sources.panel import read_panel, write_panel
from dealcast.sources.posts import read_posts, write_posts
from dealcast.sources.runs import load_run, save_run
from dealcast.streaming.rollup import read_rollup_state, stream_daily_rollup


def _scratch(spark, tag: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), f"{tag}-{uuid.uuid4().hex[:12]}")


@register("i1_i5_posts_csv_roundtrip", T.with_ctes(T.POSTS) + "SELECT * FROM posts")
def q_csv(spark, sf):
    path = _scratch(spark, "posts-csv")
    write_posts(posts(spark, sf), path)
    return read_posts(spark, path)


@register("i3_i4_panel_roundtrip", T.BASE_PANEL + """
SELECT brand, posted_date, discount_off, gwp, event_7days FROM panel""")
def q_panel_io(spark, sf):
    path = _scratch(spark, "panel")
    write_panel(panel(spark, sf), path)
    return read_panel(spark, path, ["discount_off", "gwp", "event_7days"])


@register("i6_i7_model_run_roundtrip", T.BASE_FILLED + """
SELECT brand, posted_date, discount_off AS label, true AS same FROM filled WHERE rn < n AND rn >= n - 364""")
def q_run(spark, sf):
    """A fitted tree and its predictions, saved and loaded: every test row is back, and the
    loaded model predicts what was saved."""
    tr, te, _ = reg_frames(spark, sf)
    model = M.REGRESSORS["decision_tree"](7).fit(tr)
    preds = model.transform(te).select("brand", "posted_date", "label", "prediction")
    path = _scratch(spark, "run")
    save_run(preds, model, path)
    saved, loaded = load_run(spark, path, DecisionTreeRegressionModel)
    again = loaded.transform(te).select("brand", "posted_date", F.col("prediction").alias("reloaded"))
    return saved.join(again, ["brand", "posted_date"]).select(
        "brand", "posted_date", "label", (F.col("prediction") == F.col("reloaded")).alias("same"))


AS_OF = "2002-01-01"


@register("i8_extract_deals", T.with_ctes(T.POSTS, T.PARSED) + """
SELECT brand, store, discount, strftime(posted_date, '%Y-%m-%d') AS posted_date, coalesce(comments_count, 0) AS comments_count,
  bookmarks_count, shares_count FROM parsed""")
def q_extract_deals(spark, sf):
    """Every post rendered as a listing page (one page per row), and extracted again."""
    rows = parsed(spark, sf)
    pages = rows.select("brand", F.lit(0).alias("page_id"), listing_page(rows, AS_OF).alias("html"))
    return extract_deals(pages, as_of=AS_OF)


@register("a1_streaming_rollup", T.with_ctes(T.POSTS, T.PARSED, T.DAILY) + "SELECT * FROM daily")
def q_stream(spark, sf):
    src, out, ck = _scratch(spark, "stream-src"), _scratch(spark, "stream-out"), _scratch(spark, "stream-ck")
    # four micro-batches, each of a file for every core; posts arrive in random date order
    files = spark.sparkContext.defaultParallelism
    posts(spark, sf).repartition(4 * files).write.parquet(src)
    q = stream_daily_rollup(spark, src, out, ck, max_files_per_trigger=files)
    q.awaitTermination()
    return read_rollup_state(spark, out)
