"""The streaming job: landing directory of log lines -> keyed state -> sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.config import LogFormat
from tidewatch.functions.parse import reject_lines
from tidewatch.streaming.sinks import make_batch_writer
from tidewatch.streaming.stateful import detector_factory, keyed_states, request_inputs


def start(spark: SparkSession, landing: str, out_dir: str, checkpoint: str,
          detector=("CUSUM", dict(min_n=30, delta=0.005, lam=50.0)),
          fmt: LogFormat = LogFormat(), signal=None, max_files_per_trigger: int | None = 100,
          available_now: bool = True, processing_time: str | None = None,
          publish_all_keys: bool = False, send=None,
          batch_by: str = "event_day", rocksdb: bool = False, job_conf: dict | None = None,
          source: DataFrame | None = None, source_col: str = "value",
          metric: str = "input_drift_probability", gateway: dict | None = None) -> StreamingQuery:
    """Start the drift-state stream over text files appearing in ``landing``.

    ``max_files_per_trigger`` bounds a micro-batch (back-pressure, also under
    ``availableNow``). One model's rows of one micro-batch are held by one
    Python worker while they are folded, so size it to keep a hot model's
    share of a micro-batch within a worker. The checkpoint keeps offsets and
    state, so a restart resumes where it stopped.
    ``detector``: name and options, or a factory; a univariate detector runs on
    every feature (``operators.vector``). Requests whose rows have another
    length than the model's go to ``out_dir/dim_rejects``. ``batch_by``: ``"event_day"`` (the
    day of each request; equals the table mode) or ``"arrival"`` (every
    micro-batch is one batch, stamped with its trigger time).
    """
    if job_conf is not None:                 # the reference job's configuration vocabulary
        from tidewatch.registry import detector_from_conf
        detector, _ = detector_from_conf(job_conf)
        if signal is None:
            from tidewatch.plans.inputs import identity_cells
            signal = identity_cells
    if batch_by not in ("event_day", "arrival"):
        raise ValueError("batch_by must be 'event_day' or 'arrival'")
    if rocksdb:   # state off the JVM heap for many models; fixed by the checkpoint's first run
        spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                       "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    lines = _lines(spark, landing, max_files_per_trigger, source, source_col)
    inputs = request_inputs(lines, fmt, signal)
    if batch_by == "arrival":                 # one value per micro-batch
        inputs = inputs.withColumn("batch_id", F.unix_micros(F.current_timestamp()))
    states = keyed_states(inputs, detector_factory(detector))
    writer = (states.writeStream.outputMode("update")
              .option("checkpointLocation", checkpoint)
              .foreachBatch(make_batch_writer(out_dir, metric, gateway, publish_all_keys=publish_all_keys, send=send,
                                              batch_unit="micros" if batch_by == "arrival" else "day")))
    return _triggered(writer, available_now, processing_time).start()


def start_rejects(spark: SparkSession, landing: str, out_dir: str, checkpoint: str, fmt: LogFormat = LogFormat(),
                  max_files_per_trigger: int | None = 100, available_now: bool = True,
                  processing_time: str | None = None, source: DataFrame | None = None,
                  source_col: str = "value") -> StreamingQuery:
    """Write the lines that the state stream drops, with their reason, to ``out_dir/rejects``.

    A query of its own beside ``start`` or ``start_split``, with its own
    ``checkpoint``: the state stage reads good requests only, and neither query
    waits for the other. The file sink writes each line once.
    """
    lines = _lines(spark, landing, max_files_per_trigger, source, source_col)
    writer = (reject_lines(lines, fmt).writeStream.outputMode("append").format("parquet")
              .option("path", f"{out_dir}/rejects").option("checkpointLocation", checkpoint))
    return _triggered(writer, available_now, processing_time).start()


def _lines(spark: SparkSession, landing: str, max_files: int | None, source: DataFrame | None, source_col: str) -> DataFrame:
    if source is not None:
        from tidewatch.sources.messages import lines_from
        return lines_from(source, source_col)
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(landing).select("value")


def _triggered(writer, available_now: bool, processing_time: str | None):
    if processing_time:
        return writer.trigger(processingTime=processing_time)
    return writer.trigger(availableNow=True) if available_now else writer


def write_landing(lines: DataFrame, landing: str, ts_col: str = "ts") -> None:
    """Write log lines as text files, one folder per day (test / replay feeder)."""
    (lines.withColumn("day", F.date_format(F.col(ts_col), "yyyyMMdd"))
          .repartition("day").select("value", "day")
          .write.mode("overwrite").partitionBy("day").text(landing))
