"""Parquet table sources (column pruning and filters reach the scan)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.session import table_path


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def read_events(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    return read_table(spark, sf_dir, "events", columns)
