"""Persist and reload a model run: predictions table + fitted model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def save_run(preds: DataFrame, model, path: str, partition_by: str | None = "brand") -> None:
    """Predictions as parquet (partitioned by brand when present) and the model in
    MLlib's own format under ``path/model`` (any MLWritable model or PipelineModel)."""
    w = preds.write.mode("overwrite")
    if partition_by and partition_by in preds.columns:
        w = w.partitionBy(partition_by)
    w.parquet(f"{path}/predictions")
    if model is not None:
        model.write().overwrite().save(f"{path}/model")


def load_run(spark: SparkSession, path: str, model_cls=None, brands: list[str] | None = None):
    """(predictions, model). ``brands`` is pushed down as a partition filter."""
    from pyspark.sql import functions as F
    preds = spark.read.parquet(f"{path}/predictions")
    if brands:
        preds = preds.where(F.col("brand").isin(brands))
    model = model_cls.load(f"{path}/model") if model_cls is not None else None
    return preds, model
