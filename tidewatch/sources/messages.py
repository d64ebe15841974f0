"""Message sources: any DataFrame (batch or streaming) whose messages carry log lines.

``lines_from`` normalises a message column to one ``value STRING`` row per
line: binary payloads are decoded as UTF-8 (null stays null), a message
holding several lines (``ARRAY<STRING>`` or ``ARRAY<BINARY>``) is flattened
with ``explode_outer`` (a null message stays one null line, which the parser
rejects as ``null_line``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lines_from(df: DataFrame, col: str = "value", keep: list[str] | None = None) -> DataFrame:
    keep = list(keep or [])
    t = df.schema[col].dataType
    c = F.col(col)
    if isinstance(t, T.ArrayType):
        out = df.select(*keep, F.explode_outer(c).alias("_line"))
        inner = t.elementType
        line = F.decode(F.col("_line"), "UTF-8") if isinstance(inner, T.BinaryType) else F.col("_line").cast("string")
        return out.select(*keep, line.alias("value"))
    line = F.decode(c, "UTF-8") if isinstance(t, T.BinaryType) else c.cast("string")
    return df.select(*keep, line.alias("value"))
