"""Broadcast joins behind a check of the side's size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000   # rows of a key and a few numbers: some MB


def broadcast_small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``BROADCAST_ROWS`` rows, else as it is
    (a shuffle join). The rows are counted, so pass stored or small inputs."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df
