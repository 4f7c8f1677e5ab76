"""The operators as stages of a corpus pipeline: (spark, docs, sf_dir) -> documents that go on.

All but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealcast.llm.bpe import encode_digests
from dealcast.llm.common import written
from dealcast.llm.linedup import dedup_lines
from dealcast.llm.mixing import mix
from dealcast.llm.near import judged, text_hash
from dealcast.llm.quality import screen
from dealcast.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return screen(docs).where("kept").select("doc.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs; one that consists of such copies goes."""
    rows = dedup_lines(docs).where("n_deleted = 0 or n_deleted < n_lines")
    out = [F.col(f"doc.`{c}`").alias(c) for c in docs.columns]
    if "n_chars" in docs.columns:
        length = F.when(F.col("n_deleted") > 0, F.length("doc.text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("doc.n_chars"))
        out = [length.alias("n_chars") if c == "n_chars" else x for c, x in zip(docs.columns, out)]
    return rows.select(*out)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest doc_id, then text hash.

    Decided by (doc_id, text hash), so different texts under one doc_id or under none are judged
    each for itself. Rows without words are no copies of anything, but those that share a doc_id
    and text are one document, of which one row stays.
    """
    rows = judged(docs).where(F.col("first").isNotNull() | (F.col("key").isNull() & F.col("doc_id").isNotNull()))
    stays = F.col("first").isNull() | (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.col("first.th")))
    rows = written(rows.select("doc_id", "th", stays.alias("stays")), "near-judged")
    gone = rows.where("not stays").select("doc_id", "th").distinct()
    again = written(rows.where("stays").groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id", "th"), "near-again")

    hashed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), text_hash().alias("th"))

    def among(left, right, how):
        on = F.col("l.doc.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("l.th") == F.col("r.th"))
        return left.alias("l").join(right.alias("r"), on, how)

    left = among(hashed, gone, "left_anti")
    if again.isEmpty():
        return left.select("doc.*")
    once = among(left, again, "left_anti").select("doc.*")
    one = among(left, again, "left_semi").withColumn("doc_id", F.col("doc.doc_id")).dropDuplicates(["doc_id", "th"])
    return once.unionByName(one.select("doc.*"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated towards equal square-root weights of their sources, in random order."""
    return mix(docs).select("doc.*")


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every row that is left."""
    return encode_digests(docs, tokenizer_path())
