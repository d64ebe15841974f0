"""Running aggregates per key without funnelling a key through one task.

Rows are range-partitioned and sorted by (key, order): every partition is a
chunk of the global order and of about the same size, however the rows are
spread over keys and times. Two levels:

1. each chunk computes the running values (row number, sums, minima, maxima,
   the minimum of a running sum) of its own rows per key, as numpy scans over
   Arrow batches, and marks its last row, which holds the totals of the key
   that may go on in the next chunk. The rows are stored once, since what
   follows needs the very same chunks;
2. the chunk table (two rows a chunk: the key it begins with, and the totals
   of the key it ends with) gives each chunk's first key what the chunks
   before contribute. It is joined back by chunk number, by broadcast if
   small. Later keys of a chunk need nothing.

Sums follow SQL running-sum semantics (null until a value is seen); minima
and maxima skip nulls.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.sizes import broadcast_small
from tidewatch.session import scratch_path


def _least(values: pa.Array, best: pa.Array | None, largest: bool) -> pa.Array:
    """Running minimum (maximum) of a column, ``best`` before it; structs compare field by field; nulls are skipped."""
    both = values if best is None else pa.concat_arrays([best, values])
    fields = both.flatten() if pa.types.is_struct(both.type) else [both]
    names = [f"f{i}" for i in range(len(fields))]
    order = pc.sort_indices(pa.table(fields, names=names), sort_keys=[(f, "descending" if largest else "ascending") for f in names],
                            null_placement="at_end").to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    got = both.take(pa.array(order[np.minimum.accumulate(rank)]))
    return got if best is None else got.slice(1)


class _Scans:
    """The running values of one key's rows within a chunk, piece by piece."""

    def __init__(self, sums: list[str], mins: list[str], maxs: list[str], of_sum: dict[str, str]):
        self.sums, self.mins, self.maxs, self.of_sum = sums, mins, maxs, of_sum
        self.n = 0
        self.sum = dict.fromkeys(sums, 0.0)
        self.seen = dict.fromkeys(sums, False)
        self.best: dict[str, pa.Array] = {}
        self.low = dict.fromkeys(of_sum, np.inf)

    def add(self, piece: pa.RecordBatch) -> dict[str, pa.Array]:
        out, m = {}, len(piece)
        out["count"] = pa.array(np.arange(self.n + 1, self.n + m + 1))
        self.n += m
        for s in self.sums:
            column = piece.column(f"_i_{s}")
            known = column.is_valid().to_numpy(zero_copy_only=False)
            x = np.where(known, column.cast(pa.float64()).to_numpy(zero_copy_only=False), 0.0)
            x = np.cumsum(np.concatenate([[self.sum[s]], x]))[1:]
            seen = np.logical_or.accumulate(known) | self.seen[s]
            self.sum[s], self.seen[s] = x[-1], bool(seen[-1])
            out[s] = pa.array(x, mask=~seen)
            for name, of in self.of_sum.items():
                if of == s:
                    low = np.minimum.accumulate(np.concatenate([[self.low[name]], np.where(seen, x, np.inf)]))[1:]
                    self.low[name] = low[-1]
                    out[name] = pa.array(low, mask=~seen)
        for names, largest in ((self.mins, False), (self.maxs, True)):
            for name in names:
                out[name] = _least(piece.column(f"_i_{name}"), self.best.get(name), largest)
                self.best[name] = out[name].slice(m - 1)
        return out


def running(df: DataFrame, key: str | list[str], order: list[str], count: str | None = None, sums: dict | None = None,
            mins: dict | None = None, maxs: dict | None = None, min_of_sum: dict | None = None) -> DataFrame:
    """Add global running aggregates per key in ``order``.

    ``count``: name of a 1-based row number; ``sums``/``mins``/``maxs``:
    ``{name: column}``; ``min_of_sum``: ``{name: sum_name}`` = running minimum
    of the running sum ``sum_name`` (given in ``sums``).
    """
    keys = [key] if isinstance(key, str) else list(key)
    sums, mins, maxs, mos = dict(sums or {}), dict(mins or {}), dict(maxs or {}), dict(min_of_sum or {})
    named = {**sums, **mins, **maxs}
    src = df.select("*", *[F.col(c).alias(f"_i_{n}") for n, c in named.items()])
    ranged = src.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumn("_pid", F.spark_partition_id())
    kinds = {n: src.schema[f"_i_{n}"].dataType for n in [*mins, *maxs]} | dict.fromkeys([*sums, *mos], T.DoubleType()) | {"count": T.LongType()}
    schema = T.StructType([*df.schema.fields, T.StructField("_pid", T.IntegerType()), T.StructField("_first", T.BooleanType()),
                           T.StructField("_head", T.BooleanType()), T.StructField("_last", T.BooleanType()),
                           *[T.StructField(f"_l_{n}", t) for n, t in kinds.items()]])
    plain = df.columns

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scans = held = last_key = None
        first = True               # still in the chunk's first key
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            ks = list(zip(*[batch.column(k).to_pylist() for k in keys]))
            cut = [0, *[i for i in range(1, n) if ks[i] != ks[i - 1]], n]
            pieces, firsts = [], np.zeros(n, bool)
            for a, b in zip(cut, cut[1:]):
                if scans is None or ks[a] != last_key:
                    first = scans is None
                    scans, last_key = _Scans(list(sums), list(mins), list(maxs), mos), ks[a]
                firsts[a:b] = first
                pieces.append(scans.add(batch.slice(a, b - a)))
            head = np.zeros(n, bool)
            if held is None:
                head[0] = True
            else:
                yield held
            done = [pa.concat_arrays([p[c] for p in pieces]) for c in kinds]
            held = pa.RecordBatch.from_arrays([*[batch.column(c) for c in plain], batch.column("_pid"), pa.array(firsts), pa.array(head),
                                               pa.array(np.zeros(n, bool)), *done], names=schema.names)
        if held is not None:
            last = np.zeros(len(held), bool)
            last[-1] = True
            yield held.set_column(held.schema.get_field_index("_last"), "_last", pa.array(last))

    path = scratch_path(df.sparkSession, "running")
    ranged.mapInArrow(local, schema).write.parquet(path)
    stored = df.sparkSession.read.schema(schema).parquet(path)

    # chunk table: the totals of the key a chunk ends with, and what the chunks before give to the key it begins with
    totals = stored.where("_last").select("_pid", *keys, F.lit(1).alias("_asks"), *[f"_l_{n}" for n in kinds])
    asks = stored.where("_head").select("_pid", *keys, F.lit(0).alias("_asks"), *[F.lit(None).cast(t).alias(f"_l_{n}") for n, t in kinds.items()])
    before = Window.partitionBy(*keys).orderBy("_pid", "_asks").rowsBetween(Window.unboundedPreceding, -1)
    offs = totals.unionByName(asks).select(
        "_pid", *keys, "_asks", *[F.col(f"_l_{n}") for n in mos],
        F.coalesce(F.sum("_l_count").over(before), F.lit(0)).alias("_o_count"),
        *[F.sum(f"_l_{n}").over(before).alias(f"_o_{n}") for n in sums], *[F.min(f"_l_{n}").over(before).alias(f"_o_{n}") for n in mins],
        *[F.max(f"_l_{n}").over(before).alias(f"_o_{n}") for n in maxs])
    # the totals of a chunk that goes on with a key count from that chunk's start, so sums of all chunks before are what is missing
    if mos:
        offs = offs.select("*", *[F.min(F.coalesce(F.col(f"_o_{s}"), F.lit(0.0)) + F.col(f"_l_{n}")).over(before).alias(f"_o_{n}")
                                  for n, s in mos.items()])
    offs = offs.where("_asks = 0").select("_pid", F.lit(True).alias("_first"), *[f"_o_{n}" for n in kinds])
    out = stored.join(broadcast_small(offs), ["_pid", "_first"], "left")

    def osum(n):
        o, l_ = F.col(f"_o_{n}"), F.col(f"_l_{n}")
        return F.when(o.isNull() & l_.isNull(), F.lit(None)).otherwise(F.coalesce(o, F.lit(0.0)) + F.coalesce(l_, F.lit(0.0))).cast("double")

    final = {}
    if count:
        final[count] = (F.coalesce("_o_count", F.lit(0)) + F.col("_l_count")).cast("bigint")
    for n in sums:
        final[n] = osum(n)
    for n in mins:
        final[n] = F.least(F.col(f"_l_{n}"), F.col(f"_o_{n}"))
    for n in maxs:
        final[n] = F.greatest(F.col(f"_l_{n}"), F.col(f"_o_{n}"))
    for n, s in mos.items():
        final[n] = F.least(F.coalesce(F.col(f"_o_{s}"), F.lit(0.0)) + F.col(f"_l_{n}"), F.col(f"_o_{n}"))
    return out.select(*plain, *[c.alias(n) for n, c in final.items()])


def row_index(df: DataFrame, key: str, order: list[str], name: str = "rn") -> DataFrame:
    """1-based row number per key in ``order``."""
    return running(df, key, order, count=name)
