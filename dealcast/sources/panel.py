"""Cleaned brand x day panel: parquet sink partitioned by brand (I4) and scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_panel(panel: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """One directory per brand so later per-brand reads prune partitions.

    The panel is small (brands x days), so rows are first clustered by brand:
    each task then writes one file per brand instead of one per (task, brand).
    """
    out = panel.repartition("brand").sortWithinPartitions("brand", "posted_date")
    w = out.write.mode(mode).partitionBy("brand")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def read_panel(spark: SparkSession, path: str, cols: list[str] | None = None,
               brands: list[str] | None = None) -> DataFrame:
    """Scan a written panel; ``brands`` becomes a partition filter, ``cols`` a pruned read schema."""
    df = spark.read.parquet(path)
    if brands:
        df = df.where(F.col("brand").isin(brands))
    if cols:
        keep = ["brand", "posted_date"] + [c for c in cols if c not in ("brand", "posted_date")]
        df = df.select(*keep)
    return df
