"""Per-model state across batches, as set-based DataFrame operations.

The detector fold only emits alarms; everything the state carries besides
the detector (metadata, sticky flags, warm-up, score, idle re-publication)
is expressed over the small ``(key, batch)`` table:

* grid      one row per (key, batch) with requests, metadata of the first one
* latch     flags stay set once set; the key's first batch reports 0 while the
            detector keeps learning (alarms in it are forgotten)
* snapshot  every known key is re-published in every later batch
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.metrics import drift_probability


def batch_grid(requests: DataFrame, key: str = "model_id", batch: str = "batch_id",
               order: list[str] | None = None, meta: list[str] | None = None) -> DataFrame:
    """``key, batch, n_requests`` + each ``meta`` column of the batch's first
    request in ``order`` (``min_by`` on a struct of the order columns)."""
    order = order or ["ts"]
    meta = meta or []
    o = F.struct(*[F.col(c) for c in order])
    aggs = [F.count(F.lit(1)).alias("n_requests")] + [F.min_by(F.col(m), o).alias(m) for m in meta]
    return requests.groupBy(key, batch).agg(*aggs)


def split_dims(requests: DataFrame, key: str, order: list[str], data: str) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) requests: a key's first request with numbers fixes the dimension
    (that of its first row with numbers), and a request with a row of another length is
    rejected with reason ``dim_mismatch``. Requests without rows, or with empty ones, are kept."""
    o = F.struct(*[F.col(c) for c in order])
    full = F.filter(data, lambda r: F.size(r) > 0)
    dims = requests.filter(F.size(full) > 0).groupBy(key).agg(F.min_by(F.size(F.get(full, 0)), o).alias("_dim"))
    marked = requests.join(dims, key, "left").withColumn(
        "_bad", F.exists(data, lambda r: (F.size(r) > 0) & (F.size(r) != F.col("_dim"))))
    return (marked.filter(~F.col("_bad")).drop("_dim", "_bad"),
            marked.filter("_bad").drop("_dim", "_bad").withColumn("reason", F.lit("dim_mismatch")))


def _flag(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(False))


def latch(grid: DataFrame, batch_alarms: DataFrame, key: str = "model_id", batch: str = "batch_id") -> DataFrame:
    """Sticky, warm-up-aware flags and the drift probability per (key, batch).

    ``batch_alarms`` has ``key, batch, warning, change`` = any alarm polled in
    the batch. The first batch of a key reports false/false/0; later batches
    report whether any alarm happened in batches 2..b.
    """
    j = grid.join(batch_alarms.select(key, batch, "warning", "change"), [key, batch], "left")
    first = F.min(F.col(batch)).over(Window.partitionBy(key))
    upto = Window.partitionBy(key).orderBy(batch).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later = F.col(batch) > F.col("_first")

    def sticky(c):
        return F.max(F.when(later & _flag(c), 1).otherwise(0)).over(upto) == 1

    out = (j.withColumn("_first", first)
            .withColumn("warning_detected", sticky("warning"))
            .withColumn("change_detected", sticky("change"))
            .withColumn("drift_probability", drift_probability(F.col("warning_detected"), F.col("change_detected")))
            .drop("_first", "warning", "change"))
    return out


def snapshot_all_keys(states: DataFrame, key: str = "model_id", batch: str = "batch_id",
                      carry: list[str] | None = None) -> DataFrame:
    """Every key in every batch from its first one to the last batch seen.

    An idle key keeps its last state (``last_value(.., ignoreNulls)``). The
    spine is ``explode(sequence(first, last))`` per key; the global last batch
    is a scalar subquery (one value, no join).
    """
    carry = carry or [c for c in states.columns if c not in (key, batch)]
    last = states.agg(F.max(batch)).scalar()            # uncorrelated scalar subquery, evaluated once
    firsts = states.groupBy(key).agg(F.min(batch).alias("_first"))
    spine = firsts.select(key, F.explode(F.sequence(F.col("_first"), last)).alias(batch))
    marked = states.withColumn("_has", F.lit(True))
    j = spine.join(marked, [key, batch], "left")
    w = Window.partitionBy(key).orderBy(batch).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols = [F.last(F.col(c), ignorenulls=True).over(w).alias(c) for c in carry]
    return j.select(key, batch, *cols, F.col("_has").isNull().alias("idle"))
