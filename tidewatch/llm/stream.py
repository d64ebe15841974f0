"""Whole groups from sorted Arrow batches, and pair tasks of bounded size for groups of any size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.scan import split_join


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups (rows come sorted by the long ``key``), with the offsets of the groups."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not len(b):
            continue
        k = b.column(key).to_numpy()
        last = int(np.searchsorted(k, k[-1]))
        if last or (held and held[-1].column(key)[-1].as_py() != k[-1]):
            t = pa.Table.from_batches([*held, b.slice(0, last)])
            held = []
            if len(t):
                yield t, _offsets(t, key)
        held.append(b.slice(last))
    if held:
        t = pa.Table.from_batches(held)
        yield t, _offsets(t, key)


def _offsets(t: pa.Table, key: str) -> np.ndarray:
    k = t[key].combine_chunks().to_numpy()
    return np.concatenate([[0], np.flatnonzero(k[1:] != k[:-1]) + 1, [len(k)]])


def deal_tiles(df: DataFrame, group: str, member: Column, block: int) -> DataFrame:
    """Rows of each group by tile: blocks of about ``block`` members, and a tile for each two of them.

    Adds tile (long) and side (0, 1): pairs of a tile are those between its
    sides, or within side 0 where the tile has one block. A group of up to
    ``block`` rows is one tile; one of n rows sends each row to n / block tiles.
    """
    sizes = df.groupBy(group).agg(F.count("*").alias("_n"))
    t = split_join(df, sizes, [group]).withColumn("_k", F.ceil(F.col("_n") / block).cast("int"))
    t = t.withColumn("_b", F.pmod(F.xxhash64(member, F.lit(11)), F.col("_k")).cast("int"))
    t = t.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    return (t.withColumn("tile", F.xxhash64(group, F.least("_b", "_o"), F.greatest("_b", "_o")))
            .withColumn("side", (F.col("_b") > F.col("_o")).cast("byte")).drop("_n", "_k", "_b", "_o"))


def forest(n: int, pairs: np.ndarray) -> list[tuple[int, int]]:
    """Edges (node, root) of the groups that ``pairs`` (k x 2) make of n nodes, for nodes that are no root."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in pairs.tolist():
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return [(i, r) for i in range(n) if (r := find(i)) != i]
