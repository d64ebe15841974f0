"""Score and metric-line expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Drift probability on warning and on change (change wins).
WARNING_PROBABILITY = 0.8
CHANGE_PROBABILITY = 0.9


def drift_probability(warning: Column, change: Column) -> Column:
    return (F.when(change, F.lit(CHANGE_PROBABILITY)).when(warning, F.lit(WARNING_PROBABILITY))
            .otherwise(F.lit(0.0)))


def metric_name(axon: Column, metric: str) -> Column:
    """``<metric>_<axon>`` with every ``-`` replaced by ``__``."""
    return F.replace(F.concat(F.lit(metric + "_"), axon), F.lit("-"), F.lit("__"))


def push_url(task_id: Column, gateway: str, namespace: str, port: int | str) -> Column:
    """Push-gateway URL of one model (``task_id`` is the model key)."""
    return F.concat(F.lit(f"http://{gateway}.{namespace}.svc.cluster.local:{port}/metrics/job/"),
                    task_id, F.lit("/pod/"))


def metric_line(axon: Column, value: Column, metric: str) -> Column:
    return F.concat(metric_name(axon, metric), F.lit(" "), value.cast("string"), F.lit("\n"))
