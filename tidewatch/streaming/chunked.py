"""Streaming states without a worker per model: every micro-batch is a chunked fold.

``foreachBatch`` stores the micro-batch's parsed requests, range-partitions
and sorts them with each model's stored state in front of its rows, and folds
the chunks side by side (``operators.relay``). So a model's rows of a
micro-batch are spread over tasks, stream through them, and are never held as
a whole. Model states (detector, warm-up, latch) are a table versioned by
epoch: a retried micro-batch starts from the epoch before and replaces its own
output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.config import LogFormat
from tidewatch.operators import detectors as D
from tidewatch.operators.fold import alarms_by
from tidewatch.operators.relay import Relay
from tidewatch.session import stored
from tidewatch.streaming.job import _lines, _triggered
from tidewatch.streaming.sinks import latest_epoch_path, metric_rows, state_table_rows
from tidewatch.streaming.split import latch_batches
from tidewatch.streaming.stateful import request_inputs

KEY = "model_id"
LATCH = ["first_batch", "warning_detected", "change_detected"]


def make_chunked_writer(out_dir: str, detector: Callable[[], object], metric: str = "input_drift_probability",
                        gateway: dict | None = None, send: Callable | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function over requests (``streaming.stateful.request_inputs``)."""
    gw = gateway or dict(gateway="pushgateway", namespace="monitoring", port=9091)

    def write(batch: DataFrame, epoch_id: int) -> None:
        spark, tag = batch.sparkSession, f"epoch={epoch_id}"
        path = latest_epoch_path(spark, f"{out_dir}/models", epoch_id)
        prev = None if path is None else spark.read.parquet(path)
        run = Relay(stored(batch), [KEY], ["batch_id", "ts", "insert_id"], "xs", detector, carry=["model", "axon"], heads="batch_id",
                    states=None if prev is None else prev.select(KEY, "state"), keep_states=True)
        first = F.min_by(F.struct("model", "axon"), F.struct("ts", "insert_id")).alias("_m")
        grid = run.heads().groupBy(KEY, "batch_id").agg(F.sum("n").alias("n_requests"), first)
        flags = alarms_by(run.alarms(), [KEY, "batch_id"]).withColumnsRenamed({"warning": "w", "change": "c"})
        per_batch = grid.join(flags, [KEY, "batch_id"], "left").withColumns(
            {c: F.coalesce(F.col(c), F.lit(False)) for c in ("w", "c")})
        latched = None if prev is None else prev.select(KEY, *LATCH)
        latch_batches(spark, per_batch, latched).write.mode("overwrite").parquet(f"{out_dir}/states/{tag}")
        states = spark.read.parquet(f"{out_dir}/states/{tag}")
        last = Window.partitionBy(KEY).orderBy(F.col("batch_id").desc())
        models = states.withColumn("_r", F.row_number().over(last)).where("_r = 1").select(KEY, *LATCH).join(run.states(), KEY)
        if prev is not None:
            models = models.unionByName(prev.join(models.select(KEY), KEY, "left_anti"))
        models.write.mode("overwrite").parquet(f"{out_dir}/models/{tag}")
        out = states.drop("first_batch")
        state_table_rows(out).write.mode("overwrite").parquet(f"{out_dir}/state_table/{tag}")
        rejects = run.rejects().select(KEY, "insert_id", F.lit("dim_mismatch").alias("reason"))
        rejects.write.mode("overwrite").parquet(f"{out_dir}/dim_rejects/{tag}")
        lines = metric_rows(out, metric, **gw)
        lines.write.mode("overwrite").parquet(f"{out_dir}/metrics/{tag}")
        if send is not None:
            lines.foreachPartition(send)

    return write


def start_chunked(spark: SparkSession, landing: str, out_dir: str, checkpoint: str,
                  detector=("CUSUM", dict(min_n=30, delta=0.005, lam=50.0)), fmt: LogFormat = LogFormat(), signal=None,
                  max_files_per_trigger: int | None = None, available_now: bool = True, processing_time: str | None = None,
                  source: DataFrame | None = None, source_col: str = "value", send=None,
                  metric: str = "input_drift_probability", gateway: dict | None = None) -> StreamingQuery:
    """Start the chunked state stream (see the module doc); ``detector``: name and options, or a factory, of a
    univariate detector that runs on every feature, any feature's alarm counting."""
    from functools import partial

    if not callable(detector):
        D.make_detector(detector[0], **detector[1])        # validate on the driver
        detector = partial(D.make_detector, detector[0], **detector[1])
    inputs = request_inputs(_lines(spark, landing, max_files_per_trigger, source, source_col), fmt, signal)
    writer = (inputs.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
              .foreachBatch(make_chunked_writer(out_dir, detector, metric, gateway, send)))
    return _triggered(writer, available_now, processing_time).start()
