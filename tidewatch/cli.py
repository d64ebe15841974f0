"""Command line: ``spark-submit -m``-style entry to the table and stream jobs.

    python -m tidewatch.cli table  --lines <path> --format text|parquet --out <dir> [detector flags]
    python -m tidewatch.cli stream --landing <dir> --out <dir> --checkpoint <dir> [--trigger-seconds 30]

Detector flags: ``--detector CUSUM --options '{"lam": 20}'`` for a
univariate detector on every feature (any feature's alarm counts), or ``--job-conf conf.json`` with a
job configuration in the reference vocabulary (vector detectors, ensembles).
Outputs of ``table``: ``states/`` (per model and batch), ``state_table/``,
``metrics/`` and ``rejects/`` (parquet, overwritten). ``stream`` writes the
same per epoch, and ``rejects/`` by a query of its own (``<checkpoint>-rejects``).
"""

from __future__ import annotations

import argparse
import json
import sys
from functools import partial

from pyspark.sql import functions as F

from tidewatch.config import LogFormat
from tidewatch.functions.parse import reject_lines
from tidewatch.operators.detectors import make_detector
from tidewatch.plans import inputs as I
from tidewatch.plans.queries import request_run
from tidewatch.registry import detector_from_conf
from tidewatch.streaming.push import http_sender
from tidewatch.session import get_session, stored
from tidewatch.streaming import job
from tidewatch.streaming.chunked import start_chunked
from tidewatch.streaming.sinks import metric_rows, state_table_rows
from tidewatch.streaming.stateful import detector_factory


def _detector(args):
    if args.job_conf:
        with open(args.job_conf) as fh:
            return detector_from_conf(json.load(fh))[0]
    return detector_factory((args.detector, json.loads(args.options or "{}")))


def _format(args) -> LogFormat:
    """The log markers and label keys given on the command line, as JSON of ``LogFormat`` fields."""
    return LogFormat(**json.loads(args.log_format)) if args.log_format else LogFormat()


def run_table(spark, args) -> None:
    fmt = _format(args)
    reader = spark.read.format(args.format)
    lines = reader.load(args.lines).select(F.col(args.value_col).cast("string").alias("value"))
    reqs = I.requests_of(lines, fmt)
    detector = _detector(args) if args.job_conf else (args.detector, json.loads(args.options or "{}"))
    states, refused = request_run(reqs, detector=detector, signal=I.identity_cells)
    states = stored(states)                                    # reused by three sinks
    states.write.mode("overwrite").parquet(f"{args.out}/states")
    state_table_rows(states).write.mode("overwrite").parquet(f"{args.out}/state_table")
    metric_rows(states, args.metric, args.gateway, args.namespace, args.port) \
        .write.mode("overwrite").parquet(f"{args.out}/metrics")
    reject_lines(lines, fmt).unionByName(refused.drop("model_id"), allowMissingColumns=True) \
        .write.mode("overwrite").parquet(f"{args.out}/rejects")


def run_stream(spark, args):
    gateway = dict(gateway=args.gateway, namespace=args.namespace, port=args.port)
    if args.split:
        unused = [f"--{k.replace('_', '-')}" for k, default in (
            ("job_conf", None), ("trigger_seconds", None), ("batch_by", "event_day"), ("publish_all_keys", False),
            ("rocksdb", False), ("metric", "input_drift_probability"), ("gateway", "pushgateway"),
            ("namespace", "monitoring"), ("port", 9091), ("push", False)) if getattr(args, k) != default]
        if unused:
            raise SystemExit(f"--split does not take {', '.join(unused)}")
        # feature-split state: --detector per feature, combined
        from tidewatch.streaming.split import start_split
        return start_split(spark, args.landing, args.out, args.checkpoint,
                           partial(make_detector, args.detector, **json.loads(args.options or "{}")),
                           args.combine, args.threshold, signal=I.identity_cells, fmt=_format(args),
                           max_files_per_trigger=args.max_files_per_trigger)
    if args.chunked:
        unused = [f"--{k.replace('_', '-')}" for k, default in (
            ("job_conf", None), ("batch_by", "event_day"), ("publish_all_keys", False), ("rocksdb", False)) if getattr(args, k) != default]
        if unused:
            raise SystemExit(f"--chunked does not take {', '.join(unused)}")
        return start_chunked(spark, args.landing, args.out, args.checkpoint, (args.detector, json.loads(args.options or "{}")), _format(args),
                             I.identity_cells, args.max_files_per_trigger, args.trigger_seconds is None,
                             f"{args.trigger_seconds} seconds" if args.trigger_seconds else None,
                             send=http_sender() if args.push else None, metric=args.metric, gateway=gateway)
    q = job.start(spark, args.landing, args.out, args.checkpoint, detector=_detector(args), signal=I.identity_cells,
                  max_files_per_trigger=args.max_files_per_trigger,
                  available_now=args.trigger_seconds is None,
                  processing_time=f"{args.trigger_seconds} seconds" if args.trigger_seconds else None,
                  publish_all_keys=args.publish_all_keys, batch_by=args.batch_by, rocksdb=args.rocksdb,
                  fmt=_format(args), metric=args.metric, gateway=gateway, send=http_sender() if args.push else None)
    return q


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidewatch")
    sub = p.add_subparsers(dest="mode", required=True)
    for name in ("table", "stream"):
        s = sub.add_parser(name)
        s.add_argument("--out", required=True)
        s.add_argument("--detector", default="CUSUM")
        s.add_argument("--options", default=None, help="JSON options of --detector")
        s.add_argument("--job-conf", default=None, help="JSON job configuration (overrides --detector)")
        s.add_argument("--log-format", default=None, help="JSON of LogFormat fields: markers and label keys of the logs")
        s.add_argument("--metric", default="input_drift_probability")
        s.add_argument("--gateway", default="pushgateway")
        s.add_argument("--namespace", default="monitoring")
        s.add_argument("--port", type=int, default=9091)
        if name == "table":
            s.add_argument("--lines", required=True)
            s.add_argument("--format", default="text", choices=["text", "parquet", "json", "orc"])
            s.add_argument("--value-col", default="value")
        else:
            s.add_argument("--landing", required=True)
            s.add_argument("--checkpoint", required=True)
            s.add_argument("--trigger-seconds", type=int, default=None)
            s.add_argument("--max-files-per-trigger", type=int, default=100)
            s.add_argument("--batch-by", default="event_day", choices=["event_day", "arrival"])
            s.add_argument("--publish-all-keys", action="store_true")
            s.add_argument("--push", action="store_true", help="send the metric lines over HTTP as well")
            s.add_argument("--rocksdb", action="store_true")
            s.add_argument("--split", action="store_true", help="state per (model, feature), combined per request")
            s.add_argument("--chunked", action="store_true", help="micro-batches folded in chunks, model states in a table")
            s.add_argument("--combine", default="any", choices=["any", "majority", "logistic"])
            s.add_argument("--threshold", type=float, default=0.5)
    return p


def main(argv: list[str] | None = None, spark=None):
    args = parser().parse_args(argv)
    spark = spark or get_session(app=f"tidewatch-{args.mode}")
    if args.mode == "table":
        run_table(spark, args)
        return None
    every = None if args.trigger_seconds is None else f"{args.trigger_seconds} seconds"
    q = run_stream(spark, args)
    rejects = job.start_rejects(spark, args.landing, args.out, args.checkpoint.rstrip("/") + "-rejects", _format(args),
                                args.max_files_per_trigger, every is None, every)
    q.awaitTermination()
    rejects.awaitTermination()
    return q


if __name__ == "__main__":
    main(sys.argv[1:])
