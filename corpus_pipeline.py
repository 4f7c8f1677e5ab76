"""From documents to tokens: quality rules, line dedup, near dedup, mixing, BPE.

Every stage's rows are written as Parquet to the shared folder and read again as the next
stage's documents. The near-duplicate components and the token ids are beyond SQL, so the
pipeline has no SQL twin; ``tests/llm`` hold it against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dealcast.llm import stages
from dealcast.llm.common import written
from dealcast.sources.tables import table

STAGES = [
    ("quality_rules", stages.quality_stage),
    ("line_dedup", stages.line_stage),
    ("near_dedup", stages.near_stage),
    ("mixing", stages.mixing_stage),
    ("bpe", stages.token_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
