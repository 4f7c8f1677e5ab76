"""Access to the parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan ``{sf_dir}/{name}.parquet``. Column pruning and filter pushdown reach the
    scan because callers only ever select/filter the returned frame."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

