"""Feature-vector helpers on ``data ARRAY<ARRAY<DOUBLE>>``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def vector_dim(data: Column) -> Column:
    """Dimension of a request: length of its first row (null when empty)."""
    return F.when(F.size(data) > 0, F.size(F.get(data, 0)))


def explode_vectors(requests: DataFrame, keep: list[str]) -> DataFrame:
    """Long form ``(*keep, row_idx, feature_idx, x)``: one row per cell."""
    rows = requests.select(*keep, F.posexplode("data").alias("row_idx", "_row"))
    return rows.select(*keep, "row_idx", F.posexplode("_row").alias("feature_idx", "x"))
