"""Stages of the corpus pipeline: each applies one operator to ``docs`` and lets its decision take effect.

An operator sees the columns it reads and the whole row packed in one struct,
which it hands through: columns of ``docs`` beside these keep their values
whatever their names are. All stages take nulls in any column, empty and very
long texts and repeated rows, judge whole texts, and give an empty table for
an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import bpe, jaccard_join, mixing, pii, toxicity
from tidewatch.session import ship_package, table_path

ROW = "packed_row"


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _pack(docs: DataFrame, *needed: str) -> DataFrame:
    return docs.select(*[F.col(c) for c in needed], F.struct(*[_col(c) for c in docs.columns]).alias(ROW))


def _unpack(out: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    return out.select(*[changed.get(c, F.col(ROW)[c]).alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches their language's threshold go; the classifier learns from all documents.

    A null or empty text has the score of no words; equal texts of a language
    go or stay together; without labels nothing is learned and nothing goes.
    """
    ship_package(spark)
    whole = spark.read.parquet(table_path(sf_dir, "documents"))
    model = toxicity.train(whole, spark.read.parquet(table_path(sf_dir, "labels")))
    return _unpack(toxicity.score(_pack(docs, "text", "lang"), model).where(~F.col("flagged")), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id (then text key).

    Of equal texts one row stays; rows without words are groups of their own and stay.
    """
    ship_package(spark)
    return _unpack(jaccard_join.one_of_each(_pack(docs, "doc_id", "text")), docs)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data become ``[KIND]``; n_chars follows the new text. A text without spans, or null, stays."""
    redacted = pii.redact(_pack(docs, "text"))
    return _unpack(redacted, docs, text=F.col("text"), n_chars=F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; null sources are one source, rows equal in id, source and text go alike."""
    mixed = mixing.mixed_documents(_pack(docs, "doc_id", "source", "text"), spark.read.parquet(table_path(sf_dir, "labels")))
    return _unpack(mixed, docs)


def count_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document that is left; a null text has none."""
    ship_package(spark)
    return bpe.encode(docs)
