"""Mapping of the `events` table onto model requests.

key ``model_id = event_type``; ``axon = 'ax-' || user_id % 3``; vector
``[value, user_id, props.k]``; batch = day of ``ts``; order ``(ts, event_id)``.
A drift is planted from ``DRIFT_START`` on so the detectors have something to
find: ``s = value/100 + d``, ``b = value > (50 if d else 100)``,
``u = least(value/500 + 0.4*d, 1)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DRIFT_START = "2024-01-16 00:00:00"
ORDER = ["ts", "event_id"]


def drifted(ts: str = "ts") -> Column:
    return F.col(ts) >= F.lit(DRIFT_START).cast("timestamp_ntz")


def batch_of(ts: str = "ts") -> Column:
    """Batch id = day number of the timestamp (days since 1970-01-01)."""
    return F.unix_date(F.to_date(F.col(ts))).cast("bigint")


def props_k(col: str = "props") -> Column:
    return F.get_json_object(F.col(col), "$.k").try_cast("bigint")


def with_signals(events: DataFrame) -> DataFrame:
    """Add model_id, axon, batch_id, k, d and the three planted signals."""
    d = drifted()
    return (events
            .withColumn("model_id", F.col("event_type"))
            .withColumn("axon", F.concat(F.lit("ax-"), (F.col("user_id") % 3).cast("string")))
            .withColumn("batch_id", batch_of())
            .withColumn("k", props_k())
            .withColumn("d", d)
            .withColumn("s", F.col("value") / 100 + F.when(d, 1.0).otherwise(0.0))
            .withColumn("b", F.when(F.col("value") > F.when(d, 50.0).otherwise(100.0), 1.0).otherwise(0.0))
            .withColumn("u", F.least(F.col("value") / 500 + F.when(d, 0.4).otherwise(0.0), F.lit(1.0))))
