"""Corpus pipeline: toxicity, near-duplicates, personal data, source mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``. A stage works on all rows that its
predecessor kept; tables beside the documents come from ``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import stages
from tidewatch.session import scratch_path, ship_package, table_path

STAGES = [
    ("toxicity", stages.drop_toxic),
    ("near_duplicates", stages.drop_near_duplicates),
    ("pii", stages.redact_pii),
    ("mix", stages.mix_sources),
    ("tokens", stages.count_tokens),
]

# A trained classifier, md5-keyed sampling over its survivors and the merges of a tokenizer: not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are a table in the shared folder."""
    ship_package(spark)
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
