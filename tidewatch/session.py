"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "tidewatch",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators expect."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read; a
    cluster session without it is refused. A local session (tests) gets a
    fresh folder, recorded in the session so that later callers see it too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tidewatch-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def stored(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed once and kept under the shared checkpoint folder; its lineage ends there."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def ship_package(spark: SparkSession) -> None:
    """Make ``tidewatch`` importable in the Python workers (once per context).

    The zip is made in a folder of the driver and handed to ``addPyFile``: the
    executors fetch it from the driver, so no shared folder is needed for it.
    """
    sc = spark.sparkContext
    if getattr(sc, "_tidewatch_shipped", False):
        return
    import shutil

    import tidewatch
    pkg = os.path.dirname(os.path.abspath(tidewatch.__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="tidewatch-code-"), "tidewatch")
    zpath = shutil.make_archive(base, "zip", root_dir=os.path.dirname(pkg), base_dir="tidewatch")
    sc.addPyFile(zpath)
    sc._tidewatch_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tidewatch/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
