"""Reports and maintenance on a state table
(``model_id, axon, drift_probability, timestamp``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _ts(df: DataFrame) -> Column:
    t = df.schema["timestamp"].dataType.simpleString()
    return F.to_timestamp_ntz(F.col("timestamp")) if t == "string" else F.col("timestamp").cast("timestamp_ntz")


def recent_first(states: DataFrame) -> DataFrame:
    """The whole history, newest first."""
    return states.orderBy(_ts(states).desc(), F.col("model_id"))


def latest_per_model(states: DataFrame) -> DataFrame:
    """Newest row of each model; of several with its timestamp, the latest epoch's (stream output)."""
    newest = [F.col(c).desc() for c in ("batch_id", "epoch") if c in states.columns]
    w = Window.partitionBy("model_id").orderBy(_ts(states).desc(), *newest)
    return states.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def row_count(states: DataFrame) -> DataFrame:
    return states.agg(F.count(F.lit(1)).alias("n"))


def drop_axon_older_than(states: DataFrame, axon: str, asof: str, minutes: int = 10) -> DataFrame:
    """Rows kept by the retention delete: not (this axon and older than
    ``asof - minutes``)."""
    cutoff = F.lit(asof).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    return states.filter(~((F.col("axon") == axon) & (_ts(states) < cutoff)))


def expire(states: DataFrame, asof: str, max_age_seconds: int) -> DataFrame:
    """Table expiry: rows younger than ``max_age_seconds`` at ``asof``."""
    cutoff = F.lit(asof).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(max_age_seconds)} SECONDS")
    return states.filter(_ts(states) >= cutoff)


def rewrite(spark: SparkSession, kept: DataFrame, dst: str, partition_by: str | None = None) -> DataFrame:
    """Apply a delete to a parquet table by writing the kept rows as a new
    version at ``dst`` (readers switch paths; the old version stays readable)."""
    w = kept.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(dst)
    return spark.read.parquet(dst)
