"""Prefix sums over large groups, split in chunks so that no group meets in one task.

A chunk column cuts every group into pieces that follow the order: all rows of
a lower chunk come before all rows of a higher one. Windows run within
(group, chunk); the chunk totals (groups x chunks rows) give each chunk its
offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNKS = 4096


def hash_chunk(*cols: Column | str, chunks: int = CHUNKS) -> Column:
    """Chunk of a row by the leading bits of its hash (follows the hash order)."""
    return F.floor((F.xxhash64(*cols).cast("double") / F.lit(2.0**64) + 0.5) * chunks).cast("int")


def running_sum(df: DataFrame, keys: list[str], chunk: str, order: list[str], value: Column, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the group up to this one, itself included.

    ``keys`` must not be null. Rows tied in ``order`` are taken in any order;
    make the order total where that matters.
    """
    v = df.withColumn("_v", value)
    totals = v.groupBy(*keys, chunk).agg(F.sum("_v").alias("_t"))
    before = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, chunk, F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_o"))
    within = Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (v.withColumn("_w", F.sum("_v").over(within))
            .join(offsets, [*keys, chunk])
            .withColumn(out, F.col("_w") + F.col("_o")).drop("_v", "_w", "_o"))


def with_copies(df: DataFrame) -> DataFrame:
    """``df`` with ``copy``: 1, 2, ... among equal rows.

    Equal rows are counted (a partial aggregate, so that many of them are one
    row of the shuffle) and written out again, which numbers them without a
    window over a hot row.
    """
    n = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return n.select(*df.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("copy"))


def split_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """An equi-join whose hot keys adaptive execution can split.

    Where one side is an aggregate by the same keys, Spark would join in the
    aggregate's own partitions, which cannot be split. One more key, a hash
    of the others, gives both sides a shuffle of the join's own.
    """
    h = F.xxhash64(*keys)
    return left.withColumn("_h", h).join(right.withColumn("_h", h), [*keys, "_h"], how).drop("_h")
