"""Micro-batch sinks: state table, metric lines, latest state of every key.

Each sink writes its micro-batch under ``epoch=<id>`` with overwrite, so a
retried micro-batch replaces its own output instead of duplicating it
(exactly-once per epoch on an idempotent path). Nothing is collected to the
driver; sending metric lines is a pluggable callable run on the executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.functions.metrics import metric_line, push_url


def _batch_time(unit: str = "day"):
    if unit == "micros":                      # arrival batches: trigger time in microseconds
        return F.timestamp_micros(F.col("batch_id")).cast("timestamp_ntz")
    return F.date_from_unix_date(F.col("batch_id").cast("int")).cast("timestamp_ntz")


def state_table_rows(states: DataFrame, batch_unit: str = "day") -> DataFrame:
    """``model_id, axon, drift_probability, timestamp`` (+ batch id)."""
    return states.select("model_id", "axon", "drift_probability", _batch_time(batch_unit).alias("timestamp"),
                         "batch_id")


def metric_rows(states: DataFrame, metric: str, gateway: str, namespace: str, port: int) -> DataFrame:
    return states.select(push_url(F.col("model_id"), gateway, namespace, port).alias("url"),
                         metric_line(F.col("axon"), F.col("drift_probability"), metric).alias("line"))


def read_rejects(spark: SparkSession, out_dir: str) -> DataFrame:
    """``insert_id, reason`` of the lines that ``job.start_rejects`` wrote and of the requests that the state stage refused."""
    out = spark.read.parquet(f"{out_dir}/rejects").select("insert_id", "reason")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{out_dir}/dim_rejects")
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        out = out.unionByName(spark.read.parquet(f"{out_dir}/dim_rejects").select("insert_id", "reason"))
    return out


def make_batch_writer(out_dir: str, metric: str = "input_drift_probability",
                      gateway: dict | None = None, send: Callable | None = None,
                      publish_all_keys: bool = False, batch_unit: str = "day") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function writing states, state rows and metric lines.

    ``send(rows_iterator)`` (optional) runs per partition of the metric lines
    (an HTTP push, a queue producer). With ``publish_all_keys`` the latest
    state of every key seen so far is kept in ``latest/epoch=<id>`` and
    re-published each micro-batch, idle keys included; the state table gets
    the rows of the micro-batch and, with their last batch and its time, the
    latest rows of the keys that the micro-batch lacks.
    """
    gw = gateway or dict(gateway="pushgateway", namespace="monitoring", port=9091)

    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        tag = f"epoch={epoch_id}"
        # the stateful stage runs for the first write only; the other sinks read the stored states back
        if "reject" not in batch.columns:
            batch = batch.withColumn("reject", F.lit(None).cast("string"))
        batch = batch.persist(StorageLevel.DISK_ONLY)
        rejects = batch.where(F.col("reject").isNotNull())
        kept = batch.where(F.col("reject").isNull()).drop("reject")
        kept.write.mode("overwrite").parquet(f"{out_dir}/states/{tag}")
        if not rejects.isEmpty():
            rejects.select("model_id", F.col("reject").alias("insert_id"), F.lit("dim_mismatch").alias("reason")) \
                .write.mode("overwrite").parquet(f"{out_dir}/dim_rejects/{tag}")
        batch.unpersist()
        batch = states = spark.read.schema(kept.schema).parquet(f"{out_dir}/states/{tag}")
        table = batch
        if publish_all_keys:
            states = _merge_latest(spark, batch, out_dir, epoch_id)
            states.write.mode("overwrite").parquet(f"{out_dir}/latest/{tag}")
            states = spark.read.schema(batch.schema).parquet(f"{out_dir}/latest/{tag}")
            here = batch.select(F.col("model_id").alias("_k")).distinct()
            table = batch.unionByName(states.join(here, F.col("model_id").eqNullSafe(F.col("_k")), "left_anti"))
        state_table_rows(table, batch_unit).write.mode("overwrite").parquet(f"{out_dir}/state_table/{tag}")
        lines = metric_rows(states, metric, **gw)
        lines.write.mode("overwrite").parquet(f"{out_dir}/metrics/{tag}")
        if send is not None:
            lines.foreachPartition(send)

    return write


def latest_epoch_path(spark: SparkSession, base: str, before: int) -> str | None:
    """Path of the newest ``base/epoch=<e>`` folder with ``e < before`` (one
    listing through the Hadoop FileSystem API, any store)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    best = None
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("epoch="):
            try:
                e = int(name.split("=", 1)[1])
            except ValueError:
                continue
            if e < before and (best is None or e > best):
                best = e
    return None if best is None else f"{base}/epoch={best}"


def _merge_latest(spark: SparkSession, batch: DataFrame, out_dir: str, epoch_id: int) -> DataFrame:
    prev_path = latest_epoch_path(spark, f"{out_dir}/latest", epoch_id)
    if prev_path is None:
        both = batch.withColumn("_new", F.lit(1))
    else:
        both = spark.read.parquet(prev_path).withColumn("_new", F.lit(0)).unionByName(batch.withColumn("_new", F.lit(1)))
    # of two rows of the same batch the newer epoch's holds
    w = Window.partitionBy("model_id").orderBy(F.col("batch_id").desc(), F.col("_new").desc())
    return both.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r", "_new")


def read_final_states(spark: SparkSession, out_dir: str) -> DataFrame:
    """Last emitted state per (model, batch) over all epochs."""
    s = spark.read.parquet(f"{out_dir}/states")
    w = Window.partitionBy("model_id", "batch_id").orderBy(F.col("epoch").desc())
    return s.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r", "epoch", "first_batch")
