"""Standard inputs of the registered queries, all derived from `events`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.config import LogFormat
from tidewatch.functions.parse import parse_requests
from tidewatch.functions.signals import DRIFT_START, with_signals
from tidewatch.sources.loglines import request_log_lines
from tidewatch.sources.tables import read_events, read_table

EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_events(spark, sf_dir, EVENT_COLS)


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_signals(events(spark, sf_dir))


def log_lines(spark: SparkSession, sf_dir: str, fmt: LogFormat = LogFormat()) -> DataFrame:
    return request_log_lines(events(spark, sf_dir), fmt)


def requests_of(lines: DataFrame, fmt: LogFormat = LogFormat()) -> DataFrame:
    """Parsed requests with event time and batch (day) columns."""
    return parse_requests(lines, fmt).withColumn("batch_id", F.unix_date(F.to_date("ts")).cast("bigint"))


def requests(spark: SparkSession, sf_dir: str, fmt: LogFormat = LogFormat()) -> DataFrame:
    return requests_of(log_lines(spark, sf_dir, fmt), fmt)


def vector_signal(cell, i, ts):
    """Per-cell input of the vector detectors: cell / 100, plus the planted
    shift on the first feature (``f0 = value/100 + d``, ``f1 = user_id/100``,
    ``f2 = k/100``)."""
    d = ts >= F.lit(DRIFT_START).cast("timestamp_ntz")
    return cell / 100 + F.when(d & (i == 0), 1.0).otherwise(0.0)


def with_vector_inputs(reqs: DataFrame, signal=None) -> DataFrame:
    """Requests with ``xs ARRAY<ARRAY<DOUBLE>>``: ``signal(cell, feature index, ts)`` per cell."""
    signal = signal or vector_signal
    xs = F.transform(F.col("data"), lambda r: F.transform(r, lambda c, i: signal(c, i, F.col("ts"))))
    return reqs.select("model_id", "model", "axon", "insert_id", "ts", "batch_id", xs.alias("xs"))


def wide_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of one row of 64 cells in [0, 1] from ``embeddings``: two models, 40 vectors a batch.

    Of every 400 vectors the later half has its even features moved up, and
    the forty before have feature 1 alone moved.
    """
    v = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    at = F.col("vec_id") % 400

    def cell(c, i):
        moved = ((at >= 200) & (i % 2 == 0)) | ((at >= 160) & (at < 200) & (i == 1))
        return F.least(F.greatest(F.lit(0.25) + c.cast("double") + F.when(moved, 0.75).otherwise(0.0), F.lit(0.0)), F.lit(1.0))

    return v.select(F.concat(F.lit("wide-"), (F.col("vec_id") % 2).cast("string")).alias("model_id"), F.col("vec_id").alias("event_id"),
                    F.floor(F.col("vec_id") / 40).cast("bigint").alias("batch_id"), F.array(F.transform("embedding", cell)).alias("xs"))


def identity_cells(cell, i, ts):
    """Vector detector input = the raw cell (no planted shift)."""
    return cell
