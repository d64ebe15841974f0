"""Feature-split streaming state: a hot model is spread over its features.

Stage 1 (keyed state per ``(model, feature)``) folds each feature's
univariate detector over the requests in order and emits, for every
request, the feature's flags after the request's last row and its
logistic-decay vote. Stage 2 runs in ``foreachBatch``: features are combined
per request (``any`` / ``majority`` / ``logistic``, as in
``operators.vector``), requests are OR-ed per batch, and the model's warm-up
and latch are applied with the model state (first batch, sticky flags) kept
in an epoch-versioned table of one row per model. A model's work is thus
spread over as many state keys as it has features.

Differences from ``VectorDetector`` (one state per model): every feature
present in a request is fitted (no dimension fixed by the first request),
and a feature missing from a request votes nothing for it, nor does any in a
request without features.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewatch.config import LogFormat
from tidewatch.functions.metrics import drift_probability
from tidewatch.operators.vector import COMBINE
from tidewatch.plans.inputs import requests_of
from tidewatch.streaming.sinks import latest_epoch_path, metric_rows, state_table_rows

FEATURE_STATE = "req LONG, last_change LONG, detector ARRAY<DOUBLE>"
FLAGS_SCHEMA = ("model_id STRING, feature_idx LONG, batch_id LONG, ts TIMESTAMP_NTZ, insert_id STRING, "
                "model STRING, axon STRING, warning BOOLEAN, change BOOLEAN, vote DOUBLE")
NO_FEATURE = -1
FLAG_COLUMNS = [c.split()[0] for c in FLAGS_SCHEMA.split(", ")]


def feature_rows(lines: DataFrame, fmt: LogFormat = LogFormat(), signal: Callable | None = None) -> DataFrame:
    """``model_id, feature_idx, batch_id, ts, insert_id, model, axon, xs``: one
    row per (request, feature) with that feature's values over the request's rows.
    A request without features keeps one row, of no feature and no values: it
    fits nothing but counts, and its batch may be the model's warm-up."""
    reqs = requests_of(lines, fmt)
    dim = F.coalesce(F.size(F.get(F.col("data"), 0)), F.lit(0))

    def values(i):
        return F.struct(i.cast("long").alias("f"), F.transform(F.col("data"), lambda r: F.get(r, i)).alias("v"))

    none = F.struct(F.lit(NO_FEATURE).cast("long").alias("f"),
                    F.slice(F.transform(F.col("data"), lambda r: F.get(r, 0)), 1, 0).alias("v"))
    per_feature = F.when(dim > 0, F.transform(F.sequence(F.lit(0), dim - 1), values)).otherwise(F.array(none))
    out = reqs.select("model_id", "batch_id", "ts", "insert_id", "model", "axon",
                      F.inline(per_feature).alias("feature_idx", "xs"))
    if signal is not None:
        out = out.withColumn("xs", F.transform("xs", lambda c: signal(c, F.col("feature_idx"), F.col("ts"))))
    return out


def _feature_update(detector: Callable[[], object], key: tuple, pdfs: Iterator[pd.DataFrame],
                    state: GroupState) -> Iterator[pd.DataFrame]:
    pdf = pd.concat(list(pdfs), ignore_index=True).sort_values(["batch_id", "ts", "insert_id"], kind="stable")
    det = detector()
    if state.exists:
        req, last, dv = state.get
        det.load(list(dv))
    else:
        req, last = 0, -1
    out = []
    for row in pdf.itertuples(index=False):
        w = c = False
        for x in row.xs:
            if x is None or x != x:
                continue
            w, c = det.step(float(x))
        if c:
            last = req
        vote = 0.0 if last < 0 else 1.0 / (1.0 + math.exp((req - last) - 5.0))
        out.append((key[0], int(key[1]), int(row.batch_id), row.ts, row.insert_id, row.model, row.axon,
                    bool(w), bool(c), vote))
        req += 1
    state.update((req, last, det.dump()))
    yield pd.DataFrame(out, columns=FLAG_COLUMNS)


def feature_flags(rows: DataFrame, detector: Callable[[], object]) -> DataFrame:
    return rows.groupBy("model_id", "feature_idx").applyInPandasWithState(
        partial(_feature_update, detector), FLAGS_SCHEMA, FEATURE_STATE, "update", GroupStateTimeout.NoTimeout)


def combine_requests(flags: DataFrame, combine: str = "any", threshold: float = 0.5) -> DataFrame:
    """Per request: combined (warning, change) over its features."""
    if combine not in COMBINE:
        raise ValueError(f"combine must be one of {COMBINE}")
    g = flags.groupBy("model_id", "batch_id", "insert_id")
    first = F.min_by(F.struct("model", "axon"), F.col("ts"))
    if combine == "any":
        r = g.agg(F.bool_or("warning").alias("w"), F.bool_or("change").alias("c"), F.min("ts").alias("ts"),
                  first.alias("_m"))
    else:
        score = F.avg(F.col("change").cast("double")) if combine == "majority" else F.avg("vote")
        r = g.agg((score > threshold).alias("c"), F.min("ts").alias("ts"), first.alias("_m")).withColumn("w", F.col("c"))
    return r


def latch_batch(spark: SparkSession, requests: DataFrame, prev: DataFrame | None) -> DataFrame:
    """Model states of this micro-batch: warm-up and latch continue the
    model state of earlier micro-batches (``prev``: model_id, first_batch,
    warning_detected, change_detected)."""
    return latch_batches(spark, requests.groupBy("model_id", "batch_id").agg(
        F.bool_or("w").alias("w"), F.bool_or("c").alias("c"), F.count(F.lit(1)).alias("n_requests"),
        F.min_by(F.col("_m"), F.col("ts")).alias("_m")), prev)


def latch_batches(spark: SparkSession, per_batch: DataFrame, prev: DataFrame | None) -> DataFrame:
    """``latch_batch`` from ``model_id, batch_id, w, c, n_requests, _m`` (model and axon of the batch's first request)."""
    if prev is None:
        prev = spark.createDataFrame([], "model_id string, first_batch long, warning_detected boolean, "
                                         "change_detected boolean")
    j = per_batch.join(prev.withColumnsRenamed({"warning_detected": "pw", "change_detected": "pc"}),
                       "model_id", "left")
    first = F.coalesce(F.col("first_batch"), F.min("batch_id").over(Window.partitionBy("model_id")))
    upto = Window.partitionBy("model_id").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    later = F.col("batch_id") > F.col("_first")

    def sticky(flag, prev_flag):
        now = F.max(F.when(later & F.col(flag), 1).otherwise(0)).over(upto) == 1
        return now | F.coalesce(F.col(prev_flag), F.lit(False))

    st = (j.withColumn("_first", first)
           .withColumn("warning_detected", sticky("w", "pw"))
           .withColumn("change_detected", sticky("c", "pc")))
    return st.select("model_id", "batch_id", F.col("_m.model").alias("model"), F.col("_m.axon").alias("axon"),
                     "n_requests", "warning_detected", "change_detected",
                     drift_probability(F.col("warning_detected"), F.col("change_detected")).alias("drift_probability"),
                     F.col("_first").alias("first_batch"))


def _latest_models(spark: SparkSession, out_dir: str, epoch_id: int) -> DataFrame | None:
    path = latest_epoch_path(spark, f"{out_dir}/models", epoch_id)
    return None if path is None else spark.read.parquet(path)


def make_split_writer(out_dir: str, combine: str, threshold: float, metric: str = "input_drift_probability",
                      gateway: dict | None = None):
    gw = gateway or dict(gateway="pushgateway", namespace="monitoring", port=9091)

    def write(flags: DataFrame, epoch_id: int) -> None:
        spark = flags.sparkSession
        tag = f"epoch={epoch_id}"
        prev = _latest_models(spark, out_dir, epoch_id)
        states = latch_batch(spark, combine_requests(flags, combine, threshold), prev)
        states.write.mode("overwrite").parquet(f"{out_dir}/states/{tag}")
        states = spark.read.parquet(f"{out_dir}/states/{tag}")
        w = Window.partitionBy("model_id").orderBy(F.col("batch_id").desc())
        models = states.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select(
            "model_id", "first_batch", "warning_detected", "change_detected")
        if prev is not None:
            models = prev.join(models.select("model_id"), "model_id", "left_anti").unionByName(models)
        models.write.mode("overwrite").parquet(f"{out_dir}/models/{tag}")
        out = states.drop("first_batch")
        state_table_rows(out).write.mode("overwrite").parquet(f"{out_dir}/state_table/{tag}")
        metric_rows(out, metric, **gw).write.mode("overwrite").parquet(f"{out_dir}/metrics/{tag}")

    return write


def start_split(spark: SparkSession, landing: str, out_dir: str, checkpoint: str, univariate: Callable[[], object],
                combine: str = "any", threshold: float = 0.5, fmt: LogFormat = LogFormat(), signal=None,
                max_files_per_trigger: int | None = 100, available_now: bool = True) -> StreamingQuery:
    """Start the feature-split stream (see the module doc)."""
    if combine not in COMBINE:
        raise ValueError(f"combine must be one of {COMBINE}")
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(landing).select("value")
    flags = feature_flags(feature_rows(lines, fmt, signal), univariate)
    w = (flags.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
         .foreachBatch(make_split_writer(out_dir, combine, threshold)))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
