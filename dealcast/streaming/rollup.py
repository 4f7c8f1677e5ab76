"""Day roll-up of posts as they arrive (A1, incrementally).

Posts land as files in a folder (what a scraper run produces). A streaming query
parses each micro-batch with the same column functions as the batch path and
aggregates it per (brand, day) on its own: the batch's partial aggregates are
written to ``batch=<id>`` with overwrite, so a retried batch replaces its own
output (idempotent sink) and no state store is needed.

Reading merges the partials (sums of counts, max discount, any gift). The merge
is exact whatever the arrival order: a post that arrives months late is still
counted -- no watermark drops it, and no partial row can overwrite a complete
one. ``compact_rollup`` writes a snapshot of the batches so far, merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealcast.operators.rollup import COUNTERS, parse_posts
from dealcast.sources.posts import POSTS_SCHEMA

_PARTIALS = ["n_posts", *COUNTERS, "discount_off", "gwp", "has_ad"]


def _partials(parsed: DataFrame) -> DataFrame:
    return (parsed.where(F.col("posted_date").isNotNull()).groupBy("brand", "posted_date")
            .agg(F.count(F.lit(1)).alias("n_posts"),
                 *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in COUNTERS],
                 F.max("discount_off").alias("discount_off"), F.bool_or("gwp").alias("gwp"),
                 F.bool_or("is_ad").alias("has_ad")))


def _merge(parts: DataFrame) -> DataFrame:
    return parts.groupBy("brand", "posted_date").agg(
        F.sum("n_posts").cast("bigint").alias("n_posts"),
        *[F.sum(c).cast("bigint").alias(c) for c in COUNTERS],
        F.max("discount_off").alias("discount_off"), F.bool_or("gwp").alias("gwp"),
        F.bool_or("has_ad").alias("has_ad"))


def stream_daily_rollup(spark: SparkSession, source_dir: str, out_dir: str, checkpoint_dir: str,
                        fmt: str = "parquet", schema=POSTS_SCHEMA, max_files_per_trigger: int | None = None,
                        available_now: bool = True):
    """Start the incremental roll-up; returns the StreamingQuery."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    posts = reader.load(source_dir)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        _partials(parse_posts(batch)).write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")

    w = posts.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_rollup_state(spark: SparkSession, out_dir: str) -> DataFrame:
    """The current day roll-up: all partial batches merged per (brand, day)."""
    return _merge(spark.read.parquet(out_dir).drop("batch"))


def compact_rollup(spark: SparkSession, out_dir: str, into: str) -> DataFrame:
    """Write the merged state once to ``into`` (a new folder) and return it: a snapshot of
    the batches written so far; batches that follow are only in the batch folder."""
    merged = read_rollup_state(spark, out_dir)
    merged.write.mode("overwrite").parquet(into)
    return spark.read.parquet(into)
